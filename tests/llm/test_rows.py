"""Operators that work row by row: BPE, token counts, chat, HTML, ARC."""

import base64
import hashlib
import random

import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

from tabmill.llm import arc_convert, bpe_bitmap, chat_parts, html_consensus, token_counts

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = ["", " ", "a" * 3000, "ab" * 500 + "é" * 300, "don't we'll\n\n  x\t", "a\x1cb \x85c d​e", "中文 😀 ñandú <|endoftext|>x",
       "<|startoftext|> ΣΑΣ İ ²½ 123 4", " " * 50 + "x", "tail \n"]


def test_bpe_equals_library(spark):
    import tiktoken
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = bpe_bitmap.encoder(RANKS, P.PATTERN)
    rng = random.Random(2)
    for text in ODD + ["".join(rng.choice("abthe io éöß\n19中😀'.") for _ in range(rng.randint(0, 80))) for _ in range(500)]:
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*ODD, None])], "doc_id long, text string, ids string")
    for r in bpe_bitmap.round_trip(docs, RANKS, P.PATTERN).collect():
        text = [*ODD, None][r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe_bitmap.round_trip(docs.limit(0), RANKS, P.PATTERN).count() == 0
    assert bpe_bitmap.encode_column(docs, RANKS, P.PATTERN).where("doc_id = 0").first()["ids"] == []


def test_token_counts_equal_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORDS)
    texts = [*ODD, "the the of and\nthe", None]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    for r in token_counts.token_counts(docs, WORDS, limit=20).collect():
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 20)
    assert token_counts.token_counts(docs.limit(0), WORDS).count() == 0


def test_length_table_probes_past_collisions():
    import numpy as np
    table = token_counts.LengthTable(4)
    for i in range(8):
        table.put(16 * i + 3, i + 1)
    table.put(999, 7)  # no room beyond half of the slots
    assert table.get(np.array([16 * i + 3 for i in range(8)] + [999, 5], np.uint64)).tolist() == [1, 2, 3, 4, 5, 6, 7, 8, 0, 0]


def test_chat_round_trip_and_parts(spark):
    own = "<|im_end|>\n<|im_start|>assistant ok \\n \\ <\\| <"
    rows = [(1, 0, "user", own), (1, 1, "assistant", own), (1, 2, None, None), (2, 0, "a\\nb\nc", "x"), (3, None, "assistant", "first"), (3, 1, "user", ""), (None, 0, "user", "n")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    done = chat_parts.format_conversations(turns.select("conv_id", "turn", "role", chat_parts.text_part(F.col("text")).alias("parts")))
    got = {r["conv_id"]: r for r in done.select("conv_id", chat_parts.read_turns(F.col("formatted")).alias("t"), chat_parts.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["t"]] == [("user", own), ("assistant", own), ("", "")]
    assert got[1]["loss"] == own and got[2]["t"][0]["role"] == "a\\nb\nc"
    assert [(t["role"], t["text"]) for t in got[3]["t"]] == [("assistant", "first"), ("user", "")] and len(got) == 4
    part = lambda kind, **k: (kind, k.get("text"), k.get("ref"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    parts = [part("text", text="see <|image|>"), part("image", ref="i.png", width=56, height=29), part("audio", ref="a.wav", seconds=1.5), part("document", ref="d.pdf", pages=3), part(None, text="end")]
    one = spark.createDataFrame([(1, 0, "user", parts), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts array<{chat_parts.PART_TYPE}>")
    out = {r["conv_id"]: r for r in chat_parts.format_conversations(one).collect()}
    assert out[1]["formatted"] == "<|im_start|>user\nsee <\\|image|><|image|><|audio|><|document|>end<|im_end|>\n"
    assert [(a["type"], a["ref"], a["tokens"]) for a in out[1]["attachments"]] == [("image", "i.png", 4), ("audio", "a.wav", 38), ("document", "d.pdf", 1536)]
    assert out[1]["expanded_tokens"] == 1578 and out[2]["expanded_tokens"] == 0
    assert chat_parts.format_conversations(one.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no";</script></head><body>
<div class="cookie-notice">We use cookies, really, many of them, on this site and on others</div>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<main><div class="post-%d"><h2>A &amp; B &#8212; c</h2><p>First paragraph, of some length,
  with   <b>bold</b> and <a href="#">a link</a>.<p>Second<br>one, unclosed, it says, here and there.
<ul><li>one<li>two</ul><div class="ad">Buy this now, please, it is cheap</div><form><p>Name</p></form><aside>More</aside></div>
<div id="comments"><p>Great article, very nice, I think, thanks for it, all of you</p></div></main>
<footer>&copy; us</footer></body></html>"""
TEXT = "A & B — c\nFirst paragraph, of some length, with bold and a link.\nSecond one, unclosed, it says, here and there.\none\ntwo"


def test_html_main_text(spark):
    # the last page has so little text in its post that only the host's winning path finds it
    short = ('<html><body><main><div class="post-77"><h2>A &amp; B &#8212; c</h2><p>Short</p></div><div class="teaser">'
             + "word, " * 80 + "</div></main></body></html>")
    pages = [(i, "http://Host.example/%d" % i, PAGE % i) for i in range(5)] + [(5, "https://host.example:80/x", short), (6, None, None), (7, "http://b/", ""), (8, "http://b/", "plain &lt;text"), (9, "http://c/", "<p>broken <div><!-- x")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in html_consensus.main_text(df).collect()}
    assert {got[i]["text"] for i in range(5)} == {TEXT} and got[0]["n_chars"] == len(TEXT)
    assert got[5]["text"] == "A & B — c\nShort"
    assert (got[6]["text"], got[7]["text"], got[8]["text"], got[9]["text"]) == ("", "", "plain <text", "broken")
    assert html_consensus.main_text(df.limit(0)).count() == 0


def prose(word):
    return " ".join(f"{word}{i}, and so on" for i in range(12)) + "."


def test_one_noise_word_does_not_drop_the_article():
    aside = f"<div class='sidebar'><p>{prose('side')}</p></div>"
    paragraphs = "".join(f"<p>{prose(w)}</p>" for w in ("a", "b", "c"))
    want = "\n".join(prose(w) for w in ("a", "b", "c"))
    for start, end in (("<article class='post-12 hentry category-x tag-news'>", "</article>"), ("<div class='content has-sidebar'>", "</div>"),
                       ("<main id='search-page'>", "</main>"), ("<div class='layout-widget'>", "</div>"), ("<div class='legal'>", "</div>")):
        assert html_consensus.extract(f"<body>{aside}{start}{paragraphs}{end}</body>", []) == want, start
        assert html_consensus.extract(f"<body>{start}{paragraphs}{aside}{end}</body>", []) == want, start
    assert html_consensus.extract(f"<body><div class='ad'>{paragraphs}</div><article><p>Short.</p></article></body>", []) == "Short."
    readers = f"<div class='comments-area'><article class='comment'><p>{prose('r')}</p></article>{paragraphs}{paragraphs}</div>"
    assert html_consensus.extract(f"<body><article>{paragraphs}{readers}</article></body>", []) == want


def test_split_article_is_whole(spark):
    lead, rest = "".join(f"<p>{prose(f'l{i}x')}</p>" for i in range(7)), "".join(f"<p>{prose(f'r{i}x')}</p>" for i in range(3))
    links = "".join(f"<a href='#'>another page of this site number {i}</a> " for i in range(12))
    want = "\n".join(prose(f"{c}{i}x") for c, n in (("l", 7), ("r", 3)) for i in range(n))
    page = f"<body><div class='w'><div class='lead'>{lead}</div><div class='rest'>{rest}</div></div><div class='m'><p>{links}</p></div></body>"
    deep = f"<body><div class='w'><div><div class='lead'>{lead}</div></div><div><div class='rest'>{rest}</div></div></div><div class='m'><p>{links}</p></div></body>"
    alone = f"<body><div class='w'><div class='lead'>{lead}</div></div></body>"
    assert html_consensus.extract(page, []) == want and html_consensus.extract(deep, []) == want
    df = spark.createDataFrame([(i, "http://h/", page if i < 2 else alone) for i in range(6)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_consensus.main_text(df).collect()}
    assert got[0] == got[1] == want and {got[i] for i in range(2, 6)} == {want[:want.index("r0x") - 1]}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    blocks = [arc_convert.http_block(i, data) for i, data in enumerate([b"", b"a\r\n\r\nb", b"\n\nWARC/1.1\r\n\r\n" * 3])]
    arc = arc_convert.write_arc("x.arc", [(arc_convert.arc_fields("http://a b/é"), b) for b in blocks], version)
    records = list(arc_convert.read_arc(arc))
    assert [r.block for r in records] == blocks and set(records[0].fields) == set(arc_convert.FIELDS[version])
    back = list(arc_convert.read_warc(b"".join(map(arc_convert.to_warc, records))))
    assert [b for _, b in back] == blocks
    assert back[0][0]["warc-date"] == "2000-01-01T00:00:00Z" and back[0][0]["warc-target-uri"] == "http://a%20b/é"
    with pytest.raises(ValueError):
        list(arc_convert.read_arc(arc[:-10]))


def test_pages_through_warc(spark):
    same, long = "<p>same</p>", "é" * 300_000
    pages = [(1, "http://a", same), (2, "http://b b", same), (3, "u", None), (4, None, ""), (5, "http://c", long), (9, "http://d", same), (9, "http://d", same), (None, "http://e", same)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, data string")
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"], r["payload_digest"]) for r in arc_convert.pages_through_warc(df).collect()), key=str)
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = [(1, 11, "revisit", 9, digest(same)), (2, 11, "revisit", 9, digest(same)), (3, 0, "revisit", 4, digest("")), (4, 0, "response", None, digest("")),
            (5, 600_000, "response", None, digest(long)), (9, 11, "response", None, digest(same)), (9, 11, "response", None, digest(same)), (None, 11, "revisit", 9, digest(same))]
    assert got == sorted(want, key=str)
    assert arc_convert.pages_through_warc(df.limit(0)).count() == 0

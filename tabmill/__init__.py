"""tabmill: profile, clean, select, label, split, rebalance, train and score a
wide numeric table on Spark. Every step takes and returns DataFrames."""

__version__ = "0.1.0"

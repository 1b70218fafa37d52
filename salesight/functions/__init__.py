"""Column expressions: ratios, rounding, tiers and report labels."""

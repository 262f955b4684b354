from tillroll.operators import clean, flatten, quality, reports, sums

__all__ = ["clean", "flatten", "quality", "reports", "sums"]

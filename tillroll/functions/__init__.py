from tillroll.functions import dates, money, shares

__all__ = ["dates", "money", "shares"]

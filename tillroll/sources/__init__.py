from tillroll.sources import defects, files, star, tables

__all__ = ["defects", "files", "star", "tables"]

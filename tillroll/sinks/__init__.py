from tillroll.sinks import catalog, csv, jdbc

__all__ = ["catalog", "csv", "jdbc"]

from tillroll.plans import inputs, publish, report_sets, sql_reports, star_reports

__all__ = ["inputs", "publish", "report_sets", "sql_reports", "star_reports"]

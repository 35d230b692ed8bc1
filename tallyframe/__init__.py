"""tallyframe: sales and event reporting on Spark's built-in operators.

Main entry points::

    from tallyframe import build_session, reports, money_summary, read_table
    spark = build_session()
    report = reports.revenue_by_category(read_table(spark, "/data/sf100", "orders"))
"""

from tallyframe.functions import exact_avg, exact_sum, lenient_number
from tallyframe.operators.aggregates import money_summary
from tallyframe.operators.joins import checked_broadcast, fits_broadcast, rollup_through_dimension
from tallyframe.plans import reports
from tallyframe.plans.catalog import ORACLE_SQL, QUERIES
from tallyframe.plans.sql import sql_report
from tallyframe.session import build_session, cluster_conf
from tallyframe.sinks.files import write_noop, write_parquet
from tallyframe.sources.tables import read_table

__version__ = "0.1.0"

__all__ = [
    "ORACLE_SQL",
    "QUERIES",
    "build_session",
    "checked_broadcast",
    "cluster_conf",
    "exact_avg",
    "exact_sum",
    "fits_broadcast",
    "lenient_number",
    "money_summary",
    "read_table",
    "reports",
    "rollup_through_dimension",
    "sql_report",
    "write_noop",
    "write_parquet",
]

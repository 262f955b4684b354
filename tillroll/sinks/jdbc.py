"""Output to a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll import session


def jdbc_options(
    url: str,
    table: str,
    types: dict[str, str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
    **more: str,
) -> dict[str, str]:
    """Writer options; credentials come from the caller through ``more``.

    Each task sends batches over its own connection, ``connections`` at most.
    ``truncate`` lets an overwrite empty the table and keep its declared types.
    """
    options = {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
        "truncate": "true",
        **more,
    }
    if types:
        options["createTableColumnTypes"] = ", ".join(f"{name} {kind}" for name, kind in types.items())
    return options


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kwargs) -> None:
    """Append to or overwrite a database table.

    A task that is run again sends its rows again, so an append that must hold
    each row once should go through a staging table. The rows are staged first: a
    limit on connections then narrows only the copy, not the stage that computes it.
    """
    with session.temporary(df, "jdbc") as staged:
        staged.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, **kwargs)).save()

"""Queries over the test tables and the SQL that checks them."""


def all_queries():
    from registry import io_queries, report_queries, scalar_queries, storm_queries  # noqa: F401
    from registry.catalog import QUERIES

    return dict(QUERIES)


def all_oracles():
    from registry import oracle_io, oracle_report, oracle_scalar, oracle_storm, oracle_track

    parts = (oracle_scalar, oracle_report, oracle_storm, oracle_track, oracle_io)
    return {name: sql for part in parts for name, sql in part.ORACLES.items()}

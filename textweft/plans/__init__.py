"""Named queries that put the operators to work on the given tables."""


def load_queries():
    """All registered queries and the SQL for those that SQL can check."""
    from textweft.plans import (  # noqa: F401
        classifier_queries,
        embedding_queries,
        source_queries,
        text_queries,
        vocabulary_queries,
    )
    from textweft.plans.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)

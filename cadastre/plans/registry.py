"""Where queries and the SQL that states their results are registered."""

QUERIES, ORACLE = {}, {}


def register(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add

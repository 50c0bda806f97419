"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def db(sf_dir):
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return made


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def show(x):
        return repr(round(x, 6) + 0.0) if isinstance(x, float) else str(x)

    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    cursor = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(map(tuple, df.collect()), df.columns) == canonical(cursor.fetchall(), names)


@pytest.mark.parametrize("name", [n for n in ROWS_ONLY if n not in ("l5_two_encoders", "i7_index_comparison")])
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["query_id", "pos", "score", "rank"] and df.count() == 400


def test_no_check_without_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

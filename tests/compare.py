"""Run registered queries next to their oracles: ``python tests/compare.py sf0.01 [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
          " labels conversations").split()


def oracle_connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return 0.0 if v == 0 else v
        return v

    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def oracle_rows(con, sql):
    con.execute(sql)
    return canonical([d[0] for d in con.description], con.fetchall())


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def difference(found, wanted):
    if found[0] != wanted[0]:
        return f"columns {found[0]} != {wanted[0]}"
    if len(found[1]) != len(wanted[1]):
        a, b = set(found[1]), set(wanted[1])
        return f"{len(found[1])} rows != {len(wanted[1])}; only ours {list(a - b)[:3]}; only theirs {list(b - a)[:3]}"
    bad = [(f, w) for f, w in zip(found[1], wanted[1]) if f != w]
    kinds = {(type(a).__name__, type(b).__name__) for f, w in zip(found[1], wanted[1]) for a, b in zip(f, w) if type(a) is not type(b)}
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]} | columns {found[0]}"
    return f"types differ {kinds}" if kinds else ""


def main():
    import __spark_entry__ as entry
    from kerbsight.session import build_session

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names:
        t0 = time.time()
        try:
            found = spark_rows(queries[name](spark, sf_dir))
            t1 = time.time()
            wanted = oracle_rows(con, oracles[name]) if name in oracles else found
            message = difference(found, wanted)
        except Exception as error:
            t1, message = time.time(), f"{type(error).__name__}: {str(error)[:1500]}"
            found = ([], [])
        print(f"{'FAIL' if message else 'ok  '} {name}: {len(found[1])} rows, spark {t1 - t0:.1f}s, oracle {time.time() - t1:.1f}s {message}",
              flush=True)
        failed += [name] if message else []
    print("failed:", failed)


if __name__ == "__main__":
    main()

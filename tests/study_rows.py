"""A small directory of study tables built row by row (for tests that need rows of their own)."""

import duckdb

FIRST_DAY = "TIMESTAMP '2020-01-05'"


def write_study(path, customers: int = 120, seed: int = 3, doubled: int = 0) -> str:
    """customer, nation, orders and lineitem under ``path``; the first ``doubled`` customers are there twice,
    once with another balance. Prices lie on both sides of the least one of a cease request."""
    con = duckdb.connect()
    con.execute(f"SELECT setseed({seed / 100})")
    con.execute("CREATE TABLE nation AS SELECT i AS n_nationkey, 'N' || i AS n_name FROM range(25) r(i)")
    con.execute(f"""CREATE TABLE customer AS SELECT i AS c_custkey, 'C' || i AS c_name, i * 7 % 25 AS c_nationkey, (i * 97 % 11000)::DOUBLE - 900 AS c_acctbal,
        ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][1 + i % 5] AS c_mktsegment FROM range(1, {customers + 1}) r(i)""")
    con.execute(f"INSERT INTO customer SELECT c_custkey, c_name, c_nationkey, c_acctbal + 45, c_mktsegment FROM customer WHERE c_custkey <= {doubled}")
    con.execute(f"""CREATE TABLE orders AS SELECT i AS o_orderkey, 1 + (i * 13) % {customers} AS o_custkey, CASE WHEN i % 3 = 0 THEN 'F' ELSE 'O' END AS o_orderstatus,
        CASE WHEN i % 12 = 0 THEN 440000.0 ELSE 1000.0 + i END AS o_totalprice, {FIRST_DAY} + INTERVAL (i * 37 % 900) DAY AS o_orderdate,
        ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][1 + (i // 7) % 5] AS o_orderpriority FROM range(1, {customers * 6}) r(i)""")
    con.execute("""CREATE TABLE lineitem AS SELECT o_orderkey AS l_orderkey, n AS l_linenumber, n AS l_partkey, n AS l_suppkey, o_orderdate + INTERVAL (n * 11) DAY AS l_shipdate,
        (o_orderkey * n % 997)::DOUBLE AS l_extendedprice, n::DOUBLE AS l_quantity, 'N' AS l_returnflag, 'O' AS l_linestatus FROM orders, range(1, 4) r(n)""")
    for t in ("nation", "customer", "orders", "lineitem"):
        con.execute(f"COPY {t} TO '{path}/{t}.parquet' (FORMAT parquet)")
    return str(path)

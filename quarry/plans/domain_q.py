"""P: domain jobs of the case studies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import months_between_whole
from ..operators import domain as P
from ..sources import tables
from .registry import query

AS_OF = "2002-01-01"


def _transfers_sql(batch: str, pct: str) -> str:
    return f"""
SELECT * FROM (
WITH hub AS (SELECT s_nationkey, MIN(s_suppkey) AS hub FROM supplier GROUP BY s_nationkey),
tr AS (SELECT l.l_suppkey AS src, h.hub AS dst,
              ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * {pct}, 2) AS amount
       FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN hub h ON h.s_nationkey = s.s_nationkey
       WHERE l.l_returnflag = 'R' AND l.l_shipdate >= TIMESTAMP '2001-01-01'),
d AS (SELECT acc, SUM(d) AS delta FROM (SELECT src AS acc, -amount AS d FROM tr UNION ALL SELECT dst, amount FROM tr)
      GROUP BY acc),
n AS (SELECT s.s_suppkey, CAST(s.s_acctbal AS DECIMAL(18,2)) AS old,
             CAST(s.s_acctbal AS DECIMAL(18,2)) + COALESCE(d.delta, 0) AS new
      FROM supplier s LEFT JOIN d ON d.acc = s.s_suppkey),
f AS (SELECT COUNT(*) FILTER (WHERE new < 0) AS neg FROM n)
SELECT '{batch}' AS batch, s_suppkey, CAST(CASE WHEN f.neg = 0 THEN new ELSE old END AS DOUBLE) AS s_acctbal,
       CASE WHEN f.neg = 0 THEN 'COMMITTED' ELSE 'ROLLED_BACK' END AS batch_status
FROM n, f)"""


def _transfers(spark, sf_dir, shares: dict[str, str]):
    """Each returned line since 2001 makes its supplier pay a share of the line
    value to the hub supplier (lowest key) of its nation: per batch and
    supplier the rounded amounts, summed in one scan of the lines before
    anything is joined."""
    t = tables(spark, sf_dir)
    s = t.supplier
    hub = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("dst"))
    l = t.lineitem.filter((F.col("l_returnflag") == "R")
                          & (F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")))
    part = lambda pct: F.sum(F.round(F.col("l_extendedprice").cast("decimal(18,2)")
                                     * F.lit(pct).cast("decimal(3,2)"), 2))
    paid = l.groupBy(F.col("l_suppkey").alias("src")).agg(*[part(p).alias(f"_{b}") for b, p in shares.items()])
    rows = F.array(*[F.struct(F.lit(b).alias("batch"), F.col(f"_{b}").cast("decimal(38,2)").alias("amount"))
                     for b in shares])
    return (paid.select("src", F.inline(rows)).join(s.select("s_suppkey", "s_nationkey"), F.col("src") == F.col("s_suppkey"))
            .join(hub, "s_nationkey").select("batch", "src", "dst", "amount"))


@query("transfer_batch", sql=_transfers_sql("A", "0.01") + " UNION ALL " + _transfers_sql("B", "0.80"))
def transfer_batch(spark, sf_dir):
    """Two transfer batches, each against the given balances; the small
    one commits, the large one would overdraw an account and is refused as a whole."""
    s = tables(spark, sf_dir).supplier.select("s_suppkey", "s_acctbal")
    moved = _transfers(spark, sf_dir, {"A": "0.01", "B": "0.80"})
    return reduce(DataFrame.unionByName, [
        P.transfer_batch(s, "s_suppkey", "s_acctbal", moved.filter(F.col("batch") == b), "src", "dst", "amount").select(
            F.lit(b).alias("batch"), "s_suppkey", "s_acctbal", "batch_status") for b in ("A", "B")])


# each nation's batches (one a month) walked in order; balances as a list in cents, by supplier
SEQUENCE_SQL = """
WITH RECURSIVE hub AS (SELECT s_nationkey, MIN(s_suppkey) AS hub FROM supplier GROUP BY s_nationkey),
tr AS (SELECT s.s_nationkey AS nation, (year(l_shipdate) * 12 + month(l_shipdate)) * 100 + s.s_nationkey AS batch,
              CASE WHEN l_returnflag = 'R' THEN h.hub ELSE l_suppkey END AS src,
              CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE h.hub END AS dst,
              CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.001, 2) * 100 AS BIGINT) AS c
       FROM lineitem JOIN supplier s ON s.s_suppkey = l_suppkey JOIN hub h ON h.s_nationkey = s.s_nationkey),
net AS (SELECT nation, batch, acc, SUM(d) AS d FROM (
          SELECT nation, batch, src AS acc, -c AS d FROM tr UNION ALL SELECT nation, batch, dst, c FROM tr)
        GROUP BY nation, batch, acc),
acc AS (SELECT s_nationkey AS nation, s_suppkey AS acc, CAST(round(s_acctbal * 100) AS BIGINT) AS bal FROM supplier),
grid AS (SELECT b.nation, b.batch, a.acc, n.d, ROW_NUMBER() OVER (PARTITION BY b.nation, a.acc ORDER BY b.batch) AS m
         FROM (SELECT DISTINCT nation, batch FROM net) b JOIN acc a ON a.nation = b.nation
         LEFT JOIN net n ON n.batch = b.batch AND n.acc = a.acc),
step AS (SELECT nation, batch, m, list(CAST(COALESCE(d, 0) AS BIGINT) ORDER BY acc) AS d, list(d IS NOT NULL ORDER BY acc) AS hit
         FROM grid GROUP BY nation, batch, m),
walk AS (
  SELECT nation, CAST(0 AS BIGINT) AS m, CAST(NULL AS BIGINT) AS batch, list(bal ORDER BY acc) AS bal, true AS ok
  FROM acc GROUP BY nation
  UNION ALL
  SELECT nation, m, batch, CASE WHEN ok THEN nxt ELSE bal END, ok
  FROM (SELECT nation, m, batch, bal, nxt,
               len(list_filter(range(1, len(nxt) + 1), lambda i: hit[i] AND nxt[i] < 0)) = 0 AS ok
        FROM (SELECT s.nation, s.m, CAST(s.batch AS BIGINT) AS batch, w.bal, s.hit,
                     list_transform(range(1, len(w.bal) + 1), lambda i: w.bal[i] + s.d[i]) AS nxt
              FROM walk w JOIN step s ON s.nation = w.nation AND s.m = w.m + 1) x) y)
"""


def _monthly(spark, sf_dir):
    """Every line makes its supplier pay a share to the hub supplier of its
    nation (a returned line: the other way round), in one batch per month and nation."""
    t = tables(spark, sf_dir)
    s = t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    hub = s.groupBy(F.col("s_nationkey").alias("_n")).agg(F.min("s_suppkey").alias("hub"))
    own = s.join(hub, F.col("s_nationkey") == F.col("_n")).drop("_n", "s_acctbal")
    back = F.col("l_returnflag") == "R"
    month = F.year("l_shipdate").cast("long") * 12 + F.month("l_shipdate")
    share = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("0.001").cast("decimal(4,3)"), 2)
    # summed per supplier, month and direction before the suppliers are looked up
    paid = t.lineitem.groupBy("l_suppkey", month.alias("_m"), F.coalesce(back, F.lit(False)).alias("_back")).agg(F.sum(share).alias("amount"))
    moved = paid.join(own, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("_m") * 100 + F.col("s_nationkey")).alias("batch"), F.when(F.col("_back"), F.col("hub")).otherwise(F.col("l_suppkey")).alias("src"),
        F.when(F.col("_back"), F.col("l_suppkey")).otherwise(F.col("hub")).alias("dst"), "amount")
    return P.transfer_sequence(s.drop("s_nationkey"), "s_suppkey", "s_acctbal", moved, "batch", "src", "dst", "amount")


@query("transfer_sequence", sql=SEQUENCE_SQL + """
SELECT batch, CASE WHEN ok THEN 'COMMITTED' ELSE 'ROLLED_BACK' END AS batch_status FROM walk WHERE m > 0
""")
def transfer_sequence(spark, sf_dir):
    """P1, one after the other: each batch sees what the accepted ones before
    it left (the oracle walks them with a recursive CTE)."""
    return _monthly(spark, sf_dir)[0].drop("round")


@query("transfer_balances", sql=SEQUENCE_SQL + """
SELECT a.acc AS s_suppkey, CAST(w.bal[a.i] AS DOUBLE) / 100 AS s_acctbal
FROM (SELECT nation, acc, ROW_NUMBER() OVER (PARTITION BY nation ORDER BY acc) AS i FROM acc) a
JOIN (SELECT nation, arg_max(bal, m) AS bal FROM walk GROUP BY nation) w ON w.nation = a.nation
""")
def transfer_balances(spark, sf_dir):
    """P1, one after the other: the balances after the last batch."""
    return _monthly(spark, sf_dir)[1]


# the requests walked one by one, per product
INTAKE_SQL = """
WITH RECURSIVE req AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_shipdate, l.l_extendedprice,
         CAST(p.p_size * 3 AS DOUBLE) AS stock,
         ROW_NUMBER() OVER (PARTITION BY l.l_partkey
                            ORDER BY l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS rn
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
walk AS (
  SELECT r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_suppkey, r.l_quantity, r.l_shipdate, r.l_extendedprice, r.stock, r.rn,
         r.l_quantity <= r.stock AS accepted,
         CASE WHEN r.l_quantity <= r.stock THEN r.stock - r.l_quantity ELSE r.stock END AS remaining
  FROM req r WHERE r.rn = 1
  UNION ALL
  SELECT n.l_orderkey, n.l_linenumber, n.l_partkey, n.l_suppkey, n.l_quantity, n.l_shipdate, n.l_extendedprice, n.stock, n.rn,
         n.l_quantity <= w.remaining,
         CASE WHEN n.l_quantity <= w.remaining THEN w.remaining - n.l_quantity ELSE w.remaining END
  FROM walk w JOIN req n ON n.l_partkey = w.l_partkey AND n.rn = w.rn + 1)
"""


@query("order_intake", sql=INTAKE_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, stock, accepted, remaining FROM walk
""")
def order_intake(spark, sf_dir):
    """Order requests (lines in ship order) against stock (3 x p_size):
    refused when stock < quantity, else accepted and stock decremented (the
    oracle walks the requests with a recursive CTE)."""
    return _intake(spark, sf_dir).drop("l_extendedprice")


def _intake(spark, sf_dir):
    t = tables(spark, sf_dir)
    req = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate",
                            "l_extendedprice")
    stock = t.part.select(F.col("p_partkey"), (F.col("p_size") * 3).cast("double").alias("stock"))
    r = req.join(stock, req.l_partkey == stock.p_partkey).drop("p_partkey")
    return P.order_intake(r, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                                           "l_extendedprice"], "l_quantity", "stock")


@query("order_intake_totals", sql=INTAKE_SQL + """
SELECT l_partkey, MIN(remaining) AS new_stock, COUNT(*) FILTER (WHERE accepted) AS n_accepted,
       COUNT(*) FILTER (WHERE NOT accepted) AS n_refused,
       CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE accepted), 0) AS DOUBLE) AS order_value
FROM walk GROUP BY l_partkey
""")
def order_intake_totals(spark, sf_dir):
    """What the routine writes: the new stock and the order value, per
    product of the batch."""
    return P.intake_totals(_intake(spark, sf_dir), "l_partkey", "l_quantity", "stock", "l_extendedprice")


@query("loan_issue", sql="""
SELECT o_orderkey AS emprestimo_id, o_custkey AS usuario_id, CAST(o_orderdate AS DATE) AS data_retirada,
       CAST(o_orderdate AS DATE) + 14 AS data_prevista
FROM orders
""")
def loan_issue(spark, sf_dir):
    """Loan issue: due date = +14 days."""
    o = tables(spark, sf_dir).orders
    req = o.select(F.col("o_orderkey").alias("emprestimo_id"), F.col("o_custkey").alias("usuario_id"),
                   F.to_date("o_orderdate").alias("data_retirada"))
    return P.loan_issue(req, "data_retirada")


@query("loan_return_fee", sql="""
WITH loans AS (
  SELECT o_orderkey AS emprestimo_id, CAST(o_orderdate AS DATE) + 14 AS data_prevista,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 10 END AS data_devolucao,
         CASE WHEN o_orderstatus = 'F' THEN 0.00 END AS multa
  FROM orders),
ret AS (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS rd FROM lineitem GROUP BY l_orderkey)
SELECT emprestimo_id,
       CASE WHEN data_devolucao IS NULL AND rd IS NOT NULL THEN rd ELSE data_devolucao END AS data_devolucao,
       CAST(CASE WHEN data_devolucao IS NULL AND rd IS NOT NULL
                 THEN greatest(date_diff('day', data_prevista, rd), 0) * 2.00 ELSE multa END AS DOUBLE) AS multa
FROM loans LEFT JOIN ret ON ret.l_orderkey = loans.emprestimo_id
""")
def loan_return_fee(spark, sf_dir):
    """Return batch (last ship date of each order) with a late fee of
    2.00 per day; finished (F) loans were already returned and keep theirs."""
    t = tables(spark, sf_dir)
    o = t.orders
    day = F.to_date("o_orderdate")
    loans = o.select(F.col("o_orderkey").alias("emprestimo_id"), F.date_add(day, 14).alias("data_prevista"),
                     F.when(F.col("o_orderstatus") == "F", F.date_add(day, 10)).alias("data_devolucao"),
                     F.when(F.col("o_orderstatus") == "F", F.lit(0).cast("decimal(10,2)")).alias("multa"))
    ret = t.lineitem.groupBy(F.col("l_orderkey").alias("emprestimo_id")).agg(
        F.max(F.to_date("l_shipdate")).alias("rd"))
    r = P.loan_return(loans, ret, "emprestimo_id", "rd")
    return r.select("emprestimo_id", "data_devolucao", F.col("multa").cast("double").alias("multa"))


@query("loan_latest", sql="""
SELECT l.l_orderkey, l.l_linenumber, c.c_name AS usuario, p.p_name AS titulo, l.l_shipdate AS data_retirada
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
JOIN part p ON p.p_partkey = l.l_partkey
ORDER BY l.l_shipdate DESC, l.l_orderkey DESC, l.l_linenumber DESC, l.l_partkey DESC, l.l_suppkey DESC
LIMIT 10
""")
def loan_latest(spark, sf_dir):
    """P5: the 10 latest loans with user and title, latest first. The joins
    come before the top-k, as no key is enforced: a line without its order,
    user or title does not count; each task forwards its top 10."""
    t = tables(spark, sf_dir)
    l = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    latest = [F.col(c).desc() for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", F.col("c_name").alias("usuario"))
    p = t.part.select("p_partkey", F.col("p_name").alias("titulo"))
    return (l.join(o, l.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
            .join(p, F.col("l_partkey") == p.p_partkey).orderBy(*latest).limit(10)
            .select("l_orderkey", "l_linenumber", "usuario", "titulo", F.col("l_shipdate").alias("data_retirada")))


@query("customer_tenure", sql=f"""
SELECT c.c_custkey, c.c_name, CAST(f.first AS DATE) AS data_cadastro, strftime(f.first, '%d/%m/%Y') AS cadastro_fmt,
       date_diff('day', CAST(f.first AS DATE), DATE '{AS_OF}') AS dias,
       CAST((year(DATE '{AS_OF}') - year(f.first)) * 12 + (month(DATE '{AS_OF}') - month(f.first))
            - CASE WHEN day(DATE '{AS_OF}') < day(f.first) THEN 1 ELSE 0 END AS INTEGER) AS meses
FROM customer c JOIN (SELECT o_custkey, MIN(o_orderdate) AS first FROM orders GROUP BY o_custkey) f
  ON f.o_custkey = c.c_custkey
""")
def customer_tenure(spark, sf_dir):
    """Tenure report (TO_CHAR, day difference, whole months) with an
    explicit as-of date; the first order stands for the sign-up date."""
    t = tables(spark, sf_dir)
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    c = t.customer.select("c_custkey", "c_name")
    as_of = F.lit(AS_OF).cast("date")
    return (c.join(first, c.c_custkey == first.o_custkey)
            .select("c_custkey", "c_name", F.to_date("first").alias("data_cadastro"),
                    F.date_format("first", "dd/MM/yyyy").alias("cadastro_fmt"),
                    F.datediff(as_of, F.to_date("first")).alias("dias"),
                    months_between_whole(as_of, "first").alias("meses")))


@query("customer_contacts", sql="""
SELECT c_name || ' <' || lower(replace(c_name, '#', '.')) || '@exemplo.com>' AS contato FROM customer ORDER BY c_name
""")
def customer_contacts(spark, sf_dir):
    """name/e-mail list in name order."""
    c = tables(spark, sf_dir).customer
    mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@exemplo.com"))
    return c.select(F.concat("c_name", F.lit(" <"), mail, F.lit(">")).alias("contato"), "c_name") \
        .orderBy(F.col("c_name").asc_nulls_last()).select("contato")

"""P: jobs of the course's case studies (bank, bookshop, library)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import running_sum

FEE_PER_DAY = "2.00"     # fixed value: late fee per day
LOAN_DAYS = 14           # fixed value: loan period in days


def _net(transfers: DataFrame, batch: str | None, src: str, dst: str, amount: str) -> DataFrame:
    """Net change in cents (``_d``) per account (``_acc``) and batch (``_b``). Both sides
    of a transfer come from one row; sums are made within tasks first."""
    cents = F.round(F.col(amount).cast("decimal(38,4)") * 100).cast("long")
    sides = F.array(F.struct(F.col(src).alias("_acc"), (-cents).alias("_d")),
                    F.struct(F.col(dst).alias("_acc"), cents.alias("_d")))
    by = (F.lit(0) if batch is None else F.col(batch)).alias("_b")
    return transfers.select(by, F.inline(sides)).groupBy("_b", "_acc").agg(F.sum("_d").alias("_d"))


def transfer_batch(accounts: DataFrame, key: str, balance: str, transfers: DataFrame,
                   src: str, dst: str, amount: str) -> DataFrame:
    """One all-or-nothing batch of transfers: if any resulting balance would be
    negative the whole batch is refused and the old state kept. The new balances
    are written before the verdict and the result read them."""
    from ..sources.writers import stage
    from .relational import with_scalars

    delta = _net(transfers, None, src, dst, amount)
    old = F.col(balance).cast("decimal(38,2)")
    moved = (F.coalesce(F.col("_d"), F.lit(0)).cast("decimal(38,0)") / 100).cast("decimal(38,2)")
    j = accounts.join(delta, F.col(key) == F.col("_acc"), "left")
    _, new = stage(j.select(key, old.alias("_old"), (old + moved).cast("decimal(38,2)").alias("_new")), "transfer_new")
    verdict = new.agg(F.count(F.when(F.col("_new") < 0, 1)).alias("_neg"))
    ok = F.col("_neg") == 0
    return with_scalars(new, verdict).select(
        key, F.when(ok, F.col("_new")).otherwise(F.col("_old")).alias(balance),
        F.when(ok, "COMMITTED").otherwise("ROLLED_BACK").alias("batch_status"))


def transfer_sequence(accounts: DataFrame, key: str, balance: str, transfers: DataFrame, batch: str, src: str,
                      dst: str, amount: str, n_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing batches one after the other, in the order of ``batch``:
    each sees what the accepted ones before it left, and is refused as a whole if
    an account that it changes would end below zero. Returns (batch, status,
    round) and the final balances (all columns of ``accounts``).

    The batches are decided in rounds, many at once. Two batches depend on each
    other only where the later one's verdict hangs on an account that the earlier
    one changes, and an account that all debits together cannot empty hangs on
    nothing. In a round, every open batch gets bounds for each account that it
    has to watch: the balance left by the accepted batches before it, plus all
    debits (or all credits) of the open ones before it. If the lower bounds
    suffice it is accepted, if an upper bound does not it is refused. The first
    open batch has no open one before it, so each round decides something; a chain
    of batches on one account takes several rounds only where the bounds cannot tell.

    The sums before a batch are prefix sums per account (``scan.running_sum``), so
    that an account in a third of all batches is spread over many tasks. Amounts
    have two decimals; transfers of unknown accounts change nothing there, NULL
    batches and accounts nothing at all.
    """
    from ..sources.writers import stage

    opening = F.round(F.col(balance).cast("decimal(38,4)") * 100).cast("long")
    own = accounts.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), opening.alias("_open"))
    net = _net(transfers.filter(F.col(batch).isNotNull()), batch, src, dst, amount)
    _, rows = stage(net.join(own, F.col("_acc") == F.col("_k")).select("_b", "_acc", "_d", "_open"), "transfer-rows")
    debits = F.sum(F.least(F.col("_d"), F.lit(0)))
    risky = rows.groupBy("_acc").agg(F.min("_open").alias("_o"), debits.alias("_all"))
    risky = risky.filter((F.col("_o") < 0) | (F.col("_o") + F.col("_all") < 0)).select("_acc")
    # what can be refused: rows of the accounts that could fall below zero
    _, at_risk = stage(rows.join(risky, "_acc", "left_semi").withColumn(
        "_watch", (F.col("_d") < 0) | (F.col("_open") < 0)), "transfer-risk")
    # a batch that only credits accounts which are not overdrawn is accepted whatever came before it
    watching = at_risk.filter("_watch").select("_b").distinct().withColumn("_state", F.lit("open"))
    at_risk = at_risk.join(watching, "_b", "left").withColumn("_state", F.coalesce("_state", F.lit("done")))
    decided, n = [], 0
    while True:
        is_open, done = F.col("_state") == "open", F.col("_state") == "done"
        part = lambda c, v: F.when(c, v).otherwise(F.lit(0)).cast("long")
        scanned = running_sum(at_risk.withColumns({
            "_done": part(done, F.col("_d")), "_down": part(is_open, F.least(F.col("_d"), F.lit(0))),
            "_up": part(is_open, F.greatest(F.col("_d"), F.lit(0)))}), ["_acc"], ["_b"], ["_done", "_down", "_up"], n_partitions)
        before = lambda c: F.col(f"{c}_cum") - F.col(c)
        left = F.col("_open") + before("_done") + F.col("_d")
        bounds = scanned.filter(is_open & F.col("_watch")).groupBy("_b").agg(
            F.min(left + before("_down")).alias("_low"), F.min(left + before("_up")).alias("_high"))
        verdict = F.when(F.col("_low") >= 0, "COMMITTED").when(F.col("_high") < 0, "ROLLED_BACK")
        _, told = stage(bounds.select("_b", verdict.alias("_v")).filter("_v IS NOT NULL"), "transfer-told")
        if told.isEmpty():   # no batch is left that has something to watch
            break
        n += 1
        decided.append(told.withColumn("round", F.lit(n)))
        state = F.when(F.col("_v") == "COMMITTED", "done").when(F.col("_v").isNull(), F.col("_state"))
        nxt = at_risk.join(told, "_b", "left").withColumn("_state", F.coalesce(state, F.lit("refused"))).drop("_v")
        _, at_risk = stage(nxt.filter("_state <> 'refused'"), "transfer-risk")
    told = reduce(DataFrame.unionByName, decided) if decided else None
    every = rows.select("_b").distinct()
    status = every.withColumns({"_v": F.lit("COMMITTED"), "round": F.lit(0)}) if told is None else (
        every.join(told, "_b", "left").withColumns({"_v": F.coalesce("_v", F.lit("COMMITTED")), "round": F.coalesce("round", F.lit(0))}))
    _, status = stage(status, "transfer-status")
    good = rows.join(status.filter("_v = 'COMMITTED'").select("_b"), "_b", "left_semi")
    change = good.groupBy(F.col("_acc").alias("_a")).agg(F.sum("_d").alias("_sum"))
    final = (F.coalesce(F.col("_sum"), F.lit(0)).cast("decimal(38,0)") / 100 + F.col(balance).cast("decimal(38,2)")).cast("decimal(38,2)")
    balances = accounts.join(change, F.col(key) == F.col("_a"), "left").withColumn(balance, final).drop("_a", "_sum")
    return status.select(F.col("_b").alias(batch), F.col("_v").alias("batch_status"), "round"), balances


def order_intake(requests: DataFrame, product: str, order: list[str], qty: str, stock: str,
                 n_partitions: int | None = None) -> DataFrame:
    """Adds ``accepted`` and ``remaining`` (stock left after the request): in
    ``order``, a product's request is accepted when the stock left covers it.

    Rounds over the distributed prefix sum, so one product with a third of the
    requests is spread over all tasks. In a round, requests larger than the
    stock left are refused for good (it only falls); of the others the leading
    run whose total fits is accepted. The request that ended the run is larger
    than what is then left, so the largest open quantity falls with every
    round: there are at most as many rounds as distinct quantities, and each
    sees only the requests still open. Quantities must be positive; a request
    without a quantity or a stock is refused.
    """
    from ..sources.writers import stage

    keys = [(c, True) for c in order]
    n_left = F.col(stock).cast("double").alias("_left")
    _, open_ = stage(requests.select("*", n_left), "intake")
    decided = []
    while True:
        fits = F.coalesce(F.col(qty) <= F.col("_left"), F.lit(False))
        decided.append(open_.filter(~fits).withColumn("accepted", F.lit(False)))
        small = open_.filter(fits)
        if small.isEmpty():
            break
        _, run = stage(running_sum(small, [product], keys, [qty], n_partitions), "intake_run")
        total = F.col(f"{qty}_cum")
        taken = run.filter(total <= F.col("_left"))
        decided.append(taken.drop(f"{qty}_cum").withColumn("accepted", F.lit(True)))
        used = taken.groupBy(F.col(product).alias("_p")).agg(F.max(total).alias("_used"))
        rest = run.filter(total > F.col("_left")).drop(f"{qty}_cum")
        rest = rest.join(used, rest[product].eqNullSafe(F.col("_p")), "left").withColumn(
            "_left", F.col("_left") - F.coalesce("_used", F.lit(0.0))).drop("_p", "_used")
        _, open_ = stage(rest, "intake")
    cols = [*requests.columns, "accepted"]
    every = decided[0].select(cols)
    for d in decided[1:]:
        every = every.unionByName(d.select(cols))
    every = every.withColumn("_out", F.when(F.col("accepted"), F.col(qty)).otherwise(F.lit(0.0)).cast("double"))
    out = running_sum(every, [product], keys, ["_out"], n_partitions)
    return out.withColumn("remaining", F.col(stock).cast("double") - F.col("_out_cum")).drop("_out", "_out_cum")


def intake_totals(decided: DataFrame, product: str, qty: str, stock: str, price: str) -> DataFrame:
    """Per product: the stock after the batch, requests accepted and refused,
    and the value of the accepted ones (the routine's order value), exact."""
    out = F.when(F.col("accepted"), F.col(qty)).otherwise(0.0)
    value = F.when(F.col("accepted"), F.col(price).cast("decimal(18,2)")).otherwise(F.lit(0))
    return decided.groupBy(product).agg(
        (F.max(stock) - F.sum(out)).alias("new_stock"), F.count(F.when(F.col("accepted"), 1)).alias("n_accepted"),
        F.count(F.when(~F.col("accepted"), 1)).alias("n_refused"), F.sum(value).cast("decimal(38,2)").alias("order_value"))


def loan_issue(requests: DataFrame, day: str) -> DataFrame:
    return requests.withColumn("data_prevista", F.date_add(F.col(day), LOAN_DAYS))


def loan_return(loans: DataFrame, returns: DataFrame, key: str, ret_day: str) -> DataFrame:
    """Only open loans (no return date yet) take the return date and a fee
    of 2.00 per day late; closed loans keep their values. Of several returns
    of a loan the first counts."""
    r = returns.groupBy(F.col(key).alias("_rk")).agg(F.min(ret_day).alias("_rd"))
    j = loans.join(r, loans[key] == F.col("_rk"), "left")
    is_open = F.col("data_devolucao").isNull() & F.col("_rd").isNotNull()
    late = F.greatest(F.datediff(F.col("_rd"), F.col("data_prevista")), F.lit(0))
    fee = (late.cast("decimal(10,0)") * F.lit(FEE_PER_DAY).cast("decimal(10,2)")).cast("decimal(10,2)")
    return (j.withColumn("multa", F.when(is_open, fee).otherwise(F.col("multa")))
            .withColumn("data_devolucao", F.when(is_open, F.col("_rd")).otherwise(F.col("data_devolucao")))
            .drop("_rk", "_rd"))

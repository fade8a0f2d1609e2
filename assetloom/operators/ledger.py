"""Work ledgers: an append-only event log and the states derived from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from assetloom.operators.filters import any_keyword
from assetloom.operators.joins import drop_done, update_listed
from assetloom.operators.ordering import (MAX_TOP_ROWS, cut_groups, first_rows, latest_row,
                                          number_rows)
from assetloom.session import materialize

# State codes of the five ledger dialects, and the steps a task may take.
STATE_CODES = {
    "queue": {"0": "pending", "2": "running", "1": "done", "4": "retry", "3": "failed"},
    "worker": {"pending": "pending", "downloading": "running", "completed": "done",
               "failed": "failed"},
    "playlist": {"0": "pending", "4": "queued", "2": "running", "1": "done", "3": "retry"},
    "image": {"0": "pending", "2": "running", "1": "done"},
    "json": {"0": "pending", "1": "done"},
}
STATES = ("pending", "queued", "running", "done", "retry", "failed")
ALLOWED_STEPS = (
    ("pending", "queued"), ("pending", "running"), ("queued", "running"),
    ("running", "done"), ("running", "retry"), ("running", "failed"), ("running", "pending"),
    ("retry", "queued"), ("retry", "running"), ("done", "pending"),
)


def canonical_state(dialect: Column, code: Column) -> Column:
    """One vocabulary for all dialects; unknown codes give null, an absent code
    in the ``json`` dialect is pending."""
    table = F.create_map(*(F.lit(x) for d, codes in STATE_CODES.items()
                           for c, s in codes.items() for x in (f"{d}:{c}", s)))
    found = F.try_element_at(table, F.concat_ws(":", dialect, code))
    return F.when((dialect == "json") & code.isNull(), F.lit("pending")).otherwise(found)


def current_state(events: DataFrame, key: Sequence[str],
                  newest: Sequence[str] = ("updated_at", "seq")) -> DataFrame:
    """Last event per key wins."""
    return latest_row(events, key, newest)


def transitions(events: DataFrame, key: Sequence[str], state: str,
                order: Sequence[str] = ("updated_at", "seq"),
                allowed: Sequence[tuple[str, str]] = ALLOWED_STEPS,
                pieces: int | None = None) -> DataFrame:
    """Add ``from_state`` and ``allowed``; the first event of a key is allowed."""
    stepped = (cut_groups(events, key, order, pieces)
               .running(sums={"_nth": F.lit(1)}, lags={"from_state": F.col(state)}).rows())
    step = F.concat_ws(">", "from_state", state)
    known = step.isin(*[f"{a}>{b}" for a, b in allowed])
    return stepped.withColumn("allowed", (F.col("_nth") == 1) | known).drop("_nth")


def advance(current: DataFrame, to_state: str, at: Column, host: Column | None = None,
            allowed: Sequence[tuple[str, str]] = ALLOWED_STEPS) -> tuple[DataFrame, DataFrame]:
    """Events that take tasks to ``to_state``, to be appended to the log, and the
    tasks whose state does not allow the step."""
    may = F.coalesce(F.col("state").isin(*[a for a, b in allowed if b == to_state]), F.lit(False))
    changes = {"state": F.lit(to_state), "updated_at": at, "seq": F.col("seq") + 1}
    if host is not None:
        changes["host"] = host
    return current.where(may).withColumns(changes), current.where(~may)


def state_after_failure(attempts: Column, max_attempts: int) -> Column:
    """Retry until ``max_attempts``, then failed for good."""
    return F.when(attempts >= max_attempts, F.lit("failed")).otherwise(F.lit("retry"))


def pending_by_keyword(tasks: DataFrame, text: str, keywords: Sequence[str], order: Sequence[str],
                       state: str = "download_state", pending: int = 0,
                       limit: int = 50) -> DataFrame:
    """The next batch of pending tasks that name one of the keywords."""
    wanted = any_keyword(F.col(text), keywords) & (F.col(state) == pending)
    return first_rows(tasks.where(wanted), [F.col(c) for c in order], limit)


def stuck_tasks(current: DataFrame, now: Column, minutes: int = 0, host: str | None = None,
                state: str = "state", updated: str = "updated_at") -> DataFrame:
    """Queued or running tasks untouched for ``minutes``, of one host or all."""
    held = F.col(state).isin("queued", "running")
    old = F.col(updated) <= now - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    mine = F.lit(True) if host is None else F.col("host") == host
    return current.where(held & old & mine)


def upsert(table: DataFrame, batch: DataFrame, key: str, update: Sequence[str],
           newest: Sequence[str]) -> DataFrame:
    """Insert new keys; on known keys set only the ``update`` columns.

    A null in the batch wins over the old value. Several batch rows of a key
    count as one, the newest by ``newest``.
    """
    new = latest_row(batch, [key], newest).select(
        F.col(key), F.lit(True).alias("_new"),
        *(F.col(c).alias(f"_n_{c}") for c in table.columns if c != key and c in batch.columns))
    old = table.withColumn("_old", F.lit(True))
    joined = old.join(new, key, "full_outer")

    def merged(c: str) -> Column:
        if c == key or c not in batch.columns:
            return F.col(c)
        takes_new = F.col("_new") if c in update else F.col("_old").isNull()
        return F.when(takes_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*(merged(c) for c in table.columns))


def duplicate_values(table: DataFrame, column: str) -> DataFrame:
    """Values of a should-be-unique column held by several rows."""
    return (table.where(F.col(column).isNotNull()).groupBy(column)
                 .agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"))


def insert_ignore(table: DataFrame, batch: DataFrame, key: str,
                  first: Sequence[str]) -> DataFrame:
    """Batch rows that get inserted: the first per key, keys not yet in ``table``.

    Null keys are no keys and are left out. ``table`` may repeat keys.
    """
    others = [c for c in batch.columns if c != key]
    one_each = (batch.where(F.col(key).isNotNull()).groupBy(key)
                     .agg(F.min_by(F.struct(*others), F.struct(*first)).alias("_row"))
                     .select(key, "_row.*").select(*batch.columns))
    return drop_done(one_each, table, [key])


def with_columns_added(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add missing columns as nulls of the given type; existing ones stay."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()
                           if c not in df.columns})


def append_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two versions of a table; columns absent on a side are null."""
    return old.unionByName(new, allowMissingColumns=True)


def reset_done(ledger: DataFrame, state: str = "status", keys: DataFrame | None = None,
               key: str = "url", done: int = 1, pending: int = 0) -> DataFrame:
    """Done back to pending, for all rows or the keys listed."""
    back = F.when(F.col(state) == done, F.lit(pending)).otherwise(F.col(state))
    if keys is None:
        return ledger.withColumn(state, back)
    return update_listed(ledger, keys, [key], {state: back})


def count_resets(before: DataFrame, state: str = "status", done: int = 1) -> DataFrame:
    return before.agg(F.count_if(F.col(state) == done).alias("n_reset"))


def done_rows(ledger: DataFrame, column: str = "url", state: str = "status",
              done: int = 1) -> DataFrame:
    return ledger.where(F.col(state) == done).select(column)


def assign_hosts(tasks: DataFrame, n_hosts: int, order: Sequence[str],
                 limit: int | None = None) -> DataFrame:
    """Deal tasks in ``order`` to hosts 0..n-1; loads differ by at most 1.

    With ``limit`` only the first ones are dealt (one small top-k window);
    without it the whole table is numbered in parallel.
    """
    if limit is not None and limit <= MAX_TOP_ROWS:
        first = first_rows(tasks, [F.col(c) for c in order], limit)
        numbered = first.withColumn(
            "claim_no", F.row_number().over(W.orderBy(*order)).cast("bigint"))
    else:
        numbered = number_rows(tasks, order, name="claim_no")
        if limit is not None:
            numbered = numbered.where(F.col("claim_no") <= limit)
    return numbered.withColumn("host_no", F.pmod(F.col("claim_no") - 1, F.lit(n_hosts)).cast("int"))


def claim_by_quota(tasks: DataFrame, hosts: DataFrame, order: Sequence[str], *, host: str = "host",
                   state: str = "state", quota: str = "quota", top_up: bool = False) -> DataFrame:
    """The tasks that each host takes next, with ``host`` set and ``claim``: ``own`` or ``new``.

    A host takes its own queued tasks first, the first ``quota`` of them in ``order`` (a total order). A host
    without any takes new ones, pending or to be retried; with ``top_up`` every host fills its free slots. New tasks go
    out in ``order``: the first free slots are those of the first host by name, and so on.
    ``hosts`` has one row per host; a null quota is none, tasks queued for unknown hosts stay.

    Both the slots and the waiting tasks are numbered in parallel, and number n of the one meets number n of
    the other, so neither is collected and no pairs are tried.
    """
    known = hosts.select(F.col(host).alias("_host"), F.coalesce(F.col(quota), F.lit(0)).cast("bigint").alias("_quota")).where(
        "_host IS NOT NULL AND _quota > 0")
    queued = tasks.where(F.col(state) == "queued")
    ranked = (cut_groups(queued, [host], order).running(sums={"_nth": F.lit(1)}).rows()
              .join(known, F.col(host) == F.col("_host")))
    own = materialize(ranked.where("_nth <= _quota").select(*tasks.columns, F.lit("own").alias("claim")), "own_claims")
    taken = own.groupBy(F.col(host).alias("_host")).agg(F.count(F.lit(1)).alias("_taken"))
    left = F.col("_quota") - F.coalesce("_taken", F.lit(0))
    free = known.join(taken, "_host", "left").select(
        "_host", (left if top_up else F.when(F.col("_taken").isNull(), left)).alias("_free"), F.lit(0).alias("_all"))
    spans = (cut_groups(free.where("_free > 0"), ["_all"], ["_host"]).running(sums={"_upto": F.col("_free")}).rows()
             .select("_host", (F.col("_upto") - F.col("_free") + 1).alias("_from"), "_upto"))
    # a host with very many slots unfolds in two steps, so no array holds all of them
    slots = (spans.select("_host", "_upto", F.explode(F.sequence("_from", "_upto", F.lit(SLOTS).cast("bigint"))).alias("_from"))
                  .select("_host", F.explode(F.sequence("_from", F.least(F.col("_from") + SLOTS - 1, "_upto"))).alias("_turn")))
    waiting = number_rows(tasks.where(F.col(state).isin("pending", "retry")), order, name="_turn")
    others = [F.col("_host").alias(host) if c == host else F.col(c) for c in tasks.columns]
    new = waiting.join(slots, "_turn").select(*others, F.lit("new").alias("claim"))
    return own.unionByName(new)


#: Slots of a host that are unfolded together.
SLOTS = 1000


def host_backlog(current: DataFrame, host: str = "host", state: str = "state",
                 states: Sequence[str] = STATES) -> DataFrame:
    """Tasks per host, one column per state; the states are stated, so no extra
    pass looks for them."""
    return (current.groupBy(host)
                   .agg(*(F.count_if(F.col(state) == s).alias(s) for s in states)))

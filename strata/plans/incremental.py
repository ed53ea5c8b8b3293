"""Layers in increments: a batch of raw rows moves through stored layers.

    raw batch -> clean merge -> dimension versions, fact upsert

A clean store (``CleanStore``) holds the clean tables of feeds that share a
bucket key.  Merging a batch reads the buckets of the batch's keys, lets stored
and new rows of a key compete under the cleaning layer's own order, and commits
the buckets.  The rows that the batch inserted, updated or deleted are marked
in them, and are the *change set* of the buckets' last commit (deleted rows lie
in their buckets until these are written again).  The next layer reads the change set instead of the table:
the histories take it as events, and the fact is rebuilt for the orders in it
(of the clean tables only these orders' buckets are read, of the fact only the
months that the key locator names).  After any number of batches the layers
equal a build from all raw rows at once.

Every store remembers its last batch, and a change set stays until the next
batch of its store.  A run that stopped half-way is ended by the next one:
layers that lag behind a change set apply it before anything replaces it
(``catch_up``), and a layer that has seen a batch skips it.

A batch may have a delete list a feed (keys): its rows leave the clean table,
end the key's open version and are flagged in the fact.  Deletes count after
the batch's own rows; a key sent again in a later batch is back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cdc, history
from strata.operators.dedupe import rank
from strata.plans import clean, dims, stored_fact
from strata.plans.versioned import DEFAULT_BUCKETS, BucketStore
from strata.session import Staged

CHANGE, CHANGED_AT = "_change", "_changed_at"
NEW, HELD, GONE = "_is_new", "_is_held", "_is_gone"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


class CleanStore:
    """Clean tables dealt to buckets of the same key columns, with the changes
    of the last batch."""

    def __init__(self, spark: SparkSession, path: str, feeds: Sequence[str], keys: Sequence[str],
                 n_buckets: int = DEFAULT_BUCKETS):
        self.feeds = list(feeds)
        self.store = BucketStore(spark, path, keys, n_buckets, derived={feed: clean.derived_hashes(feed) for feed in feeds})

    def read(self, feed: str, buckets: Sequence[int] | None = None, as_stored: bool = False) -> DataFrame | None:
        rows = (self.store.as_stored() if as_stored else self.store).read(feed, buckets)
        return rows if rows is None else rows.where(F.col(CHANGE).isNull() | (F.col(CHANGE) != DELETE)).drop(CHANGE, CHANGED_AT)

    def changes(self, feed: str, as_stored: bool = False) -> DataFrame | None:
        """Rows that the last batch inserted or updated (as they are now) or
        deleted (as they were), with the kind and the batch's time."""
        rows = (self.store.as_stored() if as_stored else self.store).read(feed, self.store.fresh(feed))
        return rows if rows is None else rows.where(F.col(CHANGE).isNotNull())

    def last_batch(self) -> int | None:
        m = self.store.manifest()
        return m["batch_id"] if m else None

    def apply(self, batch_id: int, at, raws: Mapping[str, DataFrame], deletes: Mapping[str, DataFrame]) -> None:
        """Merge a batch of raw rows of every feed; `at` is the changes' time."""
        if self.store.has_applied(batch_id):
            return
        with Staged(self.store.spark) as staged:
            rows, gone = {}, {}
            for feed in self.feeds:
                spec = clean.SPECS[feed]
                rows[feed] = staged.keep(clean.deduplicated(clean.typed(raws[feed], spec), spec))
                kinds = rows[feed].schema
                listed = deletes.get(feed, rows[feed].limit(0))
                gone[feed] = staged.keep(listed.select(*[F.col(k).cast(kinds[k].dataType).alias(k) for k in spec.key]).distinct())
            touched = sorted({b for part in (rows, gone) for df in part.values() for b in self.store.touched(df)})
            since = F.when(F.col(CHANGE).isNotNull(), F.lit(at).cast("timestamp"))
            tables = {feed: self._merged(feed, rows[feed], gone[feed], touched).withColumn(CHANGED_AT, since) for feed in self.feeds}
            self.store.commit(tables, touched, batch_id, as_stored=self.feeds)

    def _merged(self, feed: str, rows: DataFrame, gone: DataFrame, touched: Sequence[int]) -> DataFrame:
        """Rows of the touched buckets after the batch, and the deleted ones as
        they were, with what the batch did to them (NULL: nothing).  Stored and
        new rows meet once, in one join on the key; of the columns that
        ``clean.finished`` makes only the times are carried, the others follow
        from the values again."""
        spec = clean.SPECS[feed]
        keys = list(spec.key)
        hashes = clean.derived_hashes(feed)
        held = self.read(feed, touched, as_stored=True)
        if held is None:
            held = clean.finished(rows.limit(0), spec)
        columns, values = held.columns, [c for c in rows.columns if c not in keys]
        made = [c for c in ("_loaded_at", "_processing_timestamp") if c in columns and c not in rows.columns]
        held = held.select(*keys, *values, *made)
        batch = cdc._null_safe_join(rows.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in values], F.lit(True).alias(NEW)),
                                    gone.withColumn(GONE, F.lit(True)), keys, "full_outer")
        both = cdc._null_safe_join(held.withColumn(HELD, F.lit(True)), batch, keys, "full_outer")
        # The rank of the cleaning layer; of equal rows the stored one stays: a repeat changes nothing.
        order = [f"-{clean.INGEST_COL}"] if clean.INGEST_COL in values else []
        wins = F.col(NEW).isNotNull() & (F.col(HELD).isNull() | (rank(both, values, order, "_n_") < rank(both, values, order)))
        both = both.withColumn(NEW, wins & F.col(GONE).isNull())
        change = (F.when(F.col(NEW) & F.col(HELD).isNotNull(), UPDATE).when(F.col(NEW), INSERT)
                  .when(F.col(HELD).isNotNull() & F.col(GONE).isNotNull(), DELETE))
        chosen = both.where(F.col(NEW) | F.col(HELD).isNotNull()).select(
            *keys, *[F.when(F.col(NEW), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in values],
            *[F.col(c).alias(f"_h_{c}") for c in made], NEW, change.alias(CHANGE))
        done = clean.finished(chosen, spec).withColumns({c: F.lit(None).cast("string") for c in hashes})  # as it is stored
        return done.select(*[F.when(F.col(NEW), F.col(c)).otherwise(F.col(f"_h_{c}")).alias(c) if c in made else c
                             for c in columns], CHANGE)


def advance_history(source: CleanStore, feed: str, target: str, tracked: Sequence[str]) -> None:
    """The history at `target` takes the last change set as events."""
    keys = list(clean.SPECS[feed].key)
    batch_id = source.last_batch()
    if batch_id is None:
        return
    events = source.changes(feed).select(*keys, *tracked, F.col(CHANGED_AT).alias("changed_at"),
                                         (F.col(CHANGE) == DELETE).alias("_is_delete"))
    history.apply_to_table(source.store.spark, target, events, keys, "changed_at", tracked, batch_id=batch_id)


def advance_fact(sales: CleanStore, fact: BucketStore) -> list[int]:
    """The stored fact takes the last changes of orders and their lines; the
    months rewritten.

    A changed header changes all lines of its order, and a line waits in the
    clean table until its header is there.  Lines that lost their order or were
    deleted are flagged, if the fact has them.
    """
    batch_id = sales.last_batch()
    if batch_id is None or fact.has_applied(batch_id):
        return []
    changes = {feed: sales.changes(feed, as_stored=True) for feed in sales.feeds}

    def fact_of(parts):
        # The line's hash follows from the fact's columns too, so none is carried.
        rows = dims.fact_sales(parts["order_details"], parts["orders"])
        return rows.withColumns({c: F.lit(None).cast("string") for c in dims.FACT_HASHES})

    with Staged(fact.spark) as staged:
        def orders_of(parts):
            return staged.keep(parts["orders"].select("orderid").union(parts["order_details"].select("orderid")).distinct())

        orders = orders_of(changes)
        buckets = sales.store.touched(orders)
        now = {feed: cdc.by_key(sales.read(feed, buckets, as_stored=True), orders, ["orderid"], "left_semi") for feed in sales.feeds}
        rows = staged.keep(fact_of(now))
        if fact.manifest() is None:
            stored_fact.create(fact, rows, batch_id, True)
            return []
        removed = {feed: df.where(F.col(CHANGE) == DELETE).drop(CHANGE, CHANGED_AT) for feed, df in changes.items()}
        short = orders_of(removed)
        if not short.isEmpty():  # only orders with something removed have lost lines
            before = {feed: cdc.by_key(now[feed], short, ["orderid"], "left_semi").unionByName(removed[feed]) for feed in sales.feeds}
            lost = cdc.by_key(fact_of(before), rows, stored_fact.KEYS, "left_anti")
            lost = staged.keep(lost.withColumn(stored_fact.FLAG, F.lit(True)))
            known = fact.read(stored_fact.LOCATOR, fact.touched(lost))
            rows = rows.unionByName(cdc.by_key(lost, known, stored_fact.KEYS, "left_semi"))
        return stored_fact.upsert(fact, rows, batch_id, True)


class IncrementalLayers:
    """The stored layers under one folder: sales (orders, lines and the fact)
    and the dimensions in ``tracked`` (feed -> columns whose changes make a
    version)."""

    SALES = ("orders", "order_details")

    def __init__(self, spark: SparkSession, path: str, tracked: Mapping[str, Sequence[str]], n_buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path, self.tracked = spark, path.rstrip("/"), dict(tracked)
        self.sales = CleanStore(spark, f"{self.path}/sales", self.SALES, ["orderid"], n_buckets)
        self.fact = stored_fact.fact_store(spark, f"{self.path}/fact")
        self.dimensions = {feed: CleanStore(spark, f"{self.path}/{feed}", [feed], clean.SPECS[feed].key, n_buckets) for feed in tracked}

    def apply(self, batch_id: int, at, raws: Mapping[str, DataFrame], deletes: Mapping[str, DataFrame] | None = None) -> None:
        """Take a batch through all layers.  Batches come in the order of their
        ids; one may leave out a dimension, or both orders and lines."""
        self.catch_up()
        for store in (self.sales, *self.dimensions.values()):
            if all(feed in raws for feed in store.feeds):
                store.apply(batch_id, at, raws, deletes or {})
        self.catch_up()

    def catch_up(self) -> None:
        """Bring layers that lag behind a change set up to it."""
        advance_fact(self.sales, self.fact)
        for feed, store in self.dimensions.items():
            advance_history(store, feed, self._history(feed), self.tracked[feed])

    def _history(self, feed: str) -> str:
        return f"{self.path}/{feed}_history"

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the last versions of every store, for a caller that
        knows of no reader of older ones."""
        for store in (self.sales.store, self.fact, *(d.store for d in self.dimensions.values())):
            store.vacuum(keep)

    def read_fact(self) -> DataFrame:
        return self.fact.read(stored_fact.TABLE).drop("_bucket")

    def read_history(self, feed: str) -> DataFrame:
        return history.read_history(self.spark, self._history(feed), clean.SPECS[feed].key)

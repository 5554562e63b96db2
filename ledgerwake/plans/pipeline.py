"""Compose the models, and write them out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ledgerwake.operators import quality
from ledgerwake.operators.quality import Check, Observed
from ledgerwake.params import Params
from ledgerwake.plans import dimensions, facts, intermediate, metrics, staging
from ledgerwake.plans.checks import CHECKS
from ledgerwake.sources import files

Model = Callable[["Models"], DataFrame]

VIEW, INLINE, TABLE = "view", "inline", "table"

# Layer -> (how to materialize, models in build order).
LAYERS: dict[str, tuple[str, dict[str, Model]]] = {
    "staging": (VIEW, {
        "stg_trades": lambda m: staging.stg_trades(m["raw_trades"]),
        "stg_prices": lambda m: staging.stg_prices(m["raw_prices"]),
        "stg_cash_events": lambda m: staging.stg_cash_events(m["raw_cash_events"]),
    }),
    # Written out rather than inlined: small, and each feeds at least two facts that would
    # otherwise scan a whole feed again.
    "intermediate": (TABLE, {
        "int_trade_days": lambda m: intermediate.int_trade_days(m["stg_trades"]),
        "int_daily_prices": lambda m: intermediate.int_daily_prices(m["stg_prices"]),
        "int_cash_balances": lambda m: intermediate.int_cash_balances(m["stg_cash_events"]),
    }),
    "dimensions": (TABLE, {
        # The day-grain tables hold the same keys as the feeds they were built from.
        "dim_account": lambda m: dimensions.dim_account(
            m["int_trade_days"], m["int_cash_balances"]),
        "dim_symbol": lambda m: dimensions.dim_symbol(
            m["int_trade_days"], m["int_daily_prices"]),
        "dim_date": lambda m: dimensions.dim_date(m.spark, m.params),
    }),
    "facts": (TABLE, {
        "fact_trades": lambda m: facts.fact_trades(m["stg_trades"]),
        "fact_positions_daily": lambda m: facts.fact_positions_daily(m["int_trade_days"]),
        "fact_portfolio_value_daily": lambda m: facts.fact_portfolio_value_daily(
            facts.positions(m["int_trade_days"]), m["int_daily_prices"],
            m["int_cash_balances"]),
        "fact_pnl_daily": lambda m: facts.fact_pnl_daily(
            m["int_trade_days"], m["int_daily_prices"]),
    }),
    "metrics": (VIEW, {
        "daily_returns": lambda m: metrics.daily_returns(m["fact_portfolio_value_daily"]),
        "cumulative_returns": lambda m: metrics.cumulative_returns(m["daily_returns"]),
        "drawdown": lambda m: metrics.drawdown(m["fact_portfolio_value_daily"]),
        "rolling_volatility": lambda m: metrics.rolling_volatility(
            m["daily_returns"], m.params),
    }),
}
# Views whose rows all pass through a table as it is written, inputs first.
PASSING = {
    "fact_trades": ("raw_trades", "stg_trades"),
    "int_daily_prices": ("raw_prices", "stg_prices"),
    "int_cash_balances": ("raw_cash_events", "stg_cash_events"),
}
MODEL_NAMES = [name for _, models in LAYERS.values() for name in models]


class Models:
    """Lazy models over raw tables; each is composed once, when first asked for."""

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, DataFrame], params: Params = Params()
    ):
        self.spark, self.params = spark, params
        self._frames: dict[str, DataFrame] = dict(raw)
        # Row-level checks that were counted while a table was written.
        self.counted: dict[Check, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            define = next(models[name] for _, models in LAYERS.values() if name in models)
            self._frames[name] = define(self)
        return self._frames[name]

    def observed(self, name: str) -> tuple[DataFrame, list[Observed]]:
        """A table to write, with the checks on it and on what it is made of counted on the way."""
        inner = Models(self.spark, self._frames, self.params)
        passing = PASSING.get(name, ())
        for model in passing:
            if not model.startswith("raw_"):
                inner._frames.pop(model, None)  # to be made anew, of the observed rows
        inner._frames.pop(name, None)
        watched = []
        for model in (*passing, name):
            df, seen = quality.observed(inner[model], [c for c in CHECKS if c.model == model])
            inner.replace(model, df)
            watched += [seen] if seen else []
        return inner[name], watched

    def replace(self, name: str, df: DataFrame) -> None:
        """Let later models read ``df`` (say, a written table) under this name."""
        self._frames[name] = df


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    params: Params = Params(),
    names: Iterable[str] = MODEL_NAMES,
) -> dict[str, DataFrame]:
    """Compose the named models without running anything."""
    models = Models(spark, raw, params)
    return {name: models[name] for name in names}


def materialize(
    df: DataFrame,
    name: str,
    how: str,
    root: str = "",
    database: str = "",
    partition_by: Iterable[str] = (),
    keep_builds: int = 2,
) -> DataFrame:
    """Store a model as its layer asks and return the frame later models should read.

    A table is written to a new folder first. Its catalog entry is a view over the folder,
    replaced in one step at the end, so a reader finds the previous build or the new one,
    never nothing. The last ``keep_builds`` builds stay, for readers that are still at them.
    ``partition_by`` goes through a rebalance, which splits a hot day and merges small ones
    before the write.
    """
    spark = df.sparkSession
    if how == INLINE:
        return df
    if how == VIEW:
        df.createOrReplaceTempView(name)
        return df
    path = f"{root}/{name}/build-{uuid.uuid4().hex}"
    columns = list(partition_by)
    writer = df.hint("rebalance", *columns).write.partitionBy(*columns) if columns else df.write
    writer.option("compression", "zstd").parquet(path)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{path}`")
    _retire(spark, f"{root}/{name}", keep_builds)
    return spark.read.schema(df.schema).parquet(path)


def _retire(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete all complete builds in a model's folder but the newest ``keep``."""
    builds = [mark.removesuffix("/_SUCCESS")
              for mark in files.matching(spark, f"{folder}/build-*/_SUCCESS")]
    builds.sort(key=lambda build: files.modified(spark, build), reverse=True)
    for old in builds[max(1, keep):]:
        files.delete(spark, old)


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    params: Params = Params(),
    database_prefix: str = "",
    partition_by: Mapping[str, list[str]] | None = None,
    threads: int = 4,
    layers_as: Mapping[str, str] | None = None,
    keep_builds: int = 2,
) -> Models:
    """Build every model, layer by layer, and materialize it.

    ``layers_as`` overrides how a layer is stored. Views live as long as the session; to
    query the metrics from elsewhere, store them as tables: ``{"metrics": TABLE}``.
    """
    models = Models(spark, raw, params)

    def store(layer: str, how: str, name: str) -> DataFrame:
        database = f"{database_prefix}{layer}" if database_prefix else ""
        df, watched = models.observed(name) if how == TABLE else (models[name], [])
        stored = materialize(
            df, name, how, f"{root}/{layer}", database,
            (partition_by or {}).get(name, ()), keep_builds)
        for seen in watched:
            models.counted |= seen.failures()
        return stored

    # Tables of a layer depend on earlier layers only, so their jobs can share the cluster.
    with ThreadPoolExecutor(threads) as pool:
        for layer, (default, members) in LAYERS.items():
            how = (layers_as or {}).get(layer, default)
            stored = pool.map(lambda name: store(layer, how, name), members)
            for name, df in zip(members, stored):
                models.replace(name, df)
    return models


def check(models: Models) -> DataFrame:
    """All declared data tests; those counted while tables were written are not run again."""
    return quality.run_checks({c.model: models[c.model] for c in CHECKS}, CHECKS, models.counted)

"""Stored portfolios: portfolios and their holdings, committed together.

A commit writes both tables below a folder of its own and marks that folder last; the
marked folder with the highest number is the current version. Until then readers see the
version before, and a commit that dies leaves both tables as they were. The version before
the current one stays, for readers that have begun with it; older ones and dead commits are
removed by the next commit. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import portfolio
from barloom.schemas import HOLDING_KEY, HOLDINGS, PORTFOLIOS
from barloom.sources import folders
from barloom.sources.files import read_table, write_table

COMPLETE = "complete"
ID_DIGITS = 32


@dataclass(frozen=True)
class PortfolioStore:
    """The two tables below one folder."""

    spark: SparkSession
    root: str

    def _versions(self) -> list[str]:
        """Names of the complete versions, the current one last."""
        found = [n for n in folders.names(self.spark, self.root) if n.startswith("version-")]
        return [n for n in found if COMPLETE in folders.names(self.spark, f"{self.root}/{n}")]

    def _read(self, name: str, schema) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, f"{self.root}/{versions[-1]}/{name}", schema)

    def portfolios(self) -> DataFrame:
        return self._read("portfolios", PORTFOLIOS)

    def holdings(self) -> DataFrame:
        return self._read("holdings", HOLDINGS)

    def _commit(self, rows: DataFrame | None, change: Callable) -> None:
        """`change` gets the staged rows and a function that writes the new holdings and returns
        them as stored, and returns the new portfolios."""
        before = self._versions()
        number = int(before[-1].split("-")[1]) + 1 if before else 1
        name = f"version-{number:010d}-{uuid.uuid4().hex}"
        folder = f"{self.root}/{name}"
        if rows is not None:  # used by several jobs, so it is computed once
            rows.write.parquet(f"{folder}/requests")
            rows = self.spark.read.schema(rows.schema).parquet(f"{folder}/requests")

        def write_holdings(changed: DataFrame) -> DataFrame:
            write_table(changed.select(*HOLDINGS.fieldNames()), f"{folder}/holdings", HOLDING_KEY)
            return read_table(self.spark, f"{folder}/holdings", HOLDINGS)

        portfolios = change(rows, write_holdings)
        write_table(portfolios.select(*PORTFOLIOS.fieldNames()), f"{folder}/portfolios", ["name"])
        folders.mark(self.spark, f"{folder}/{COMPLETE}")
        folders.remove(self.spark, f"{folder}/requests")
        for old in folders.names(self.spark, self.root):
            if old.startswith("version-") and old not in (name, *before[-1:]):
                folders.remove(self.spark, f"{self.root}/{old}")

    def conflicts(self, requests: DataFrame) -> DataFrame:
        """Why requests would be refused, one row per portfolio and reason."""
        return portfolio.portfolio_conflicts(portfolio.by_name(self.portfolios()), requests)

    def create(self, requests: DataFrame, now: datetime) -> None:
        """Adds the portfolios of requests(portfolio, ticker, weight) that have no conflicts."""
        known, held = self.portfolios(), self.holdings()

        def change(rows: DataFrame, write_holdings: Callable) -> DataFrame:
            fresh = portfolio.create_portfolios(portfolio.by_name(known), rows)
            stored = write_holdings(held.unionByName(fresh))
            names = stored.select(F.col("portfolio").alias("name")).distinct()
            made = F.lit(now).cast("timestamp")
            key = F.sha2(F.concat_ws("\n", made.cast("string"), "name"), 256)
            new = names.join(known, "name", "left_anti").select(
                F.left(key, F.lit(ID_DIGITS)).alias("portfolio_id"),
                "name",
                made.alias("created_at"),
                made.alias("updated_at"),
            )
            return known.unionByName(new)

        self._commit(requests, change)

    def replace(self, replacement: DataFrame, now: datetime) -> None:
        """New holdings of the portfolios whose replacement is not refused; their updated time."""
        known, held = self.portfolios(), self.holdings()

        def change(rows: DataFrame, write_holdings: Callable) -> DataFrame:
            write_holdings(portfolio.replace_holdings(held, rows))
            refused = portfolio.replacement_conflicts(held, rows).select("portfolio").distinct()
            touched = rows.select("portfolio").distinct().join(refused, "portfolio", "left_anti")
            touched = touched.select(F.col("portfolio").alias("name"), F.lit(now).alias("changed"))
            return known.join(touched, "name", "left").withColumn(
                "updated_at", F.coalesce(F.col("changed").cast("timestamp"), "updated_at")
            )

        self._commit(replacement, change)

    def delete(self, doomed: DataFrame) -> None:
        """Removes the portfolios that doomed(portfolio) names, with their holdings."""
        known, held = self.portfolios(), self.holdings()

        def change(rows: DataFrame, write_holdings: Callable) -> DataFrame:
            left, legs = portfolio.delete_portfolios(portfolio.by_name(known), held, rows)
            write_holdings(legs)
            return left.withColumnRenamed("portfolio", "name")

        self._commit(doomed.select("portfolio").distinct(), change)

    def page(self, limit: int = 50, offset: int = 0) -> DataFrame:
        """A page of portfolios in the order of their creation, each with its holdings."""
        return portfolio.portfolio_page(self.portfolios(), self.holdings(), limit, offset)

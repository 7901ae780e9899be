"""The verification report on a record table, as lazy frames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from corpusmill.functions.predicates import between_range, match, match_keyword, since
from corpusmill.functions.scalars import snippet, text_stats
from corpusmill.operators.aggregates import (
    count_queries, entity_readiness, estimate_entities, latest, profile, table_stats,
)


@dataclass(frozen=True)
class RecordReport:
    """What to report on. The defaults fit the record schema of this library."""

    terms: Mapping[str, int] = field(
        default_factory=lambda: {
            "product_line": 10, "product_model": 20, "retailer": 15, "region": 15,
            "interaction_type": 20, "customer_segment": 10, "sales_channel": 10,
        }
    )
    metrics: tuple[str, ...] = ("price", "revenue_potential")
    key: str = "id"
    ts: str = "timestamp"
    interval: str = "year"
    persons: tuple[str, ...] = ("customer_name", "sales_representative")
    organization: str = "retailer"
    location: str = "location_city"
    money: str = "price"
    text: str = "interaction_text"

    def stats(self, df: DataFrame, *, files: bool = True) -> DataFrame:
        return table_stats(df, files=files)

    def newest(self, df: DataFrame, n: int = 5, chars: int = 100) -> DataFrame:
        return latest(df, self.ts, n, self.key).withColumn("shown", snippet(self.text, chars))

    def distribution(self, df: DataFrame) -> DataFrame:
        return profile(df, self.terms, self.metrics, (self.ts, self.interval))

    def readiness(self, df: DataFrame) -> DataFrame:
        return entity_readiness(
            df,
            persons=self.persons,
            organization=self.organization,
            location=self.location,
            money=self.money,
            date=self.ts,
            text=self.text,
        )

    def text_analysis(self, df: DataFrame) -> DataFrame:
        return df.select(
            self.key, *(c.alias(n) for n, c in text_stats(self.text).items()),
            estimate_entities(self.text).alias("n_entities"),
        )

    def counts(self, df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
        return count_queries(df, predicates)

    def sample_counts(
        self, df: DataFrame, line: str, retailer: str, words: str, as_of: str
    ) -> DataFrame:
        """The five standard counts, with the values to look for."""
        return self.counts(
            df,
            {
                "product_line": match_keyword("product_line", line),
                "high_value": between_range(self.money, gte=300),
                "retailer": match(self.organization, retailer),
                "recent": since(self.ts, "30d", as_of),
                "words": match(self.text, words),
            },
        )

"""All queries of the core, by name, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loamline.plans import air_quality, chat, chunks, coverage, documents, market_prices, news, payloads, search, soil, star

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        **star.queries(),
        **coverage.queries(),
        **soil.queries(),
        **documents.queries(),
        **search.queries(),
        **chunks.queries(),
        **chat.queries(),
        **news.queries(),
        **payloads.queries(),
        "p4_prices": market_prices.p4_prices,
        "p4_found": market_prices.p4_found,
        "p4_imputed": market_prices.p4_imputed,
        "p4_calibration": market_prices.p4_calibration,
        "p5_grid": air_quality.p5_grid,
        "p5_found": air_quality.p5_found,
        "p6_flags": air_quality.p6_flags,
        "p6_found": air_quality.p6_found,
    }


def oracle_sql() -> dict[str, str]:
    return {
        **star.oracle_sql(), **coverage.oracle_sql(), **soil.oracle_sql(), **documents.oracle_sql(), **search.oracle_sql(), **chat.oracle_sql(),
        **news.oracle_sql(), **payloads.oracle_sql(), **air_quality.oracle_sql(), **market_prices.oracle_sql(),
    }

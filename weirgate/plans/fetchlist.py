"""Crawl index to fetch list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from weirgate.operators.captures import fetch_requests, unique_captures, usable_captures
from weirgate.operators.worklist import build_worklist


def fetch_list(cdx: DataFrame, order: list[Column], now: Column, min_length: int = 10_000) -> DataFrame:
    """Usable captures, one per key, digest and URL, numbered in capture order."""
    order_columns = unique_captures(usable_captures(cdx, min_length), order)
    return build_worklist(order_columns, order, now)


def request_list(cdx: DataFrame, order: list[Column], min_length: int = 10_000) -> DataFrame:
    """The same without numbering."""
    return fetch_requests(unique_captures(usable_captures(cdx, min_length), order))

"""Staging models: one per raw feed, lazy views over the source."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame

from farebox.operators.conform import to_contract
from farebox.schemas import FHV_CONTRACT, GREEN_CONTRACT, YELLOW_CONTRACT
from farebox.sources.files import first_rows


def stg_green_tripdata(raw: DataFrame, sample_rows: int | None = None, uncast: Collection[str] = ()) -> DataFrame:
    return first_rows(to_contract(raw, GREEN_CONTRACT, required="VendorID", uncast=uncast), sample_rows)


def stg_yellow_tripdata(raw: DataFrame, sample_rows: int | None = None, uncast: Collection[str] = ()) -> DataFrame:
    return first_rows(to_contract(raw, YELLOW_CONTRACT, required="VendorID", uncast=uncast), sample_rows)


def stg_fhv_tripdata(raw: DataFrame, sample_rows: int | None = None) -> DataFrame:
    return first_rows(to_contract(raw, FHV_CONTRACT, required="dispatching_base_num"), sample_rows)

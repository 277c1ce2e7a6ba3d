"""Runs queries next to their SQL: ``python -m checks.compare <sf dir> [name ..]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.queries import QUERIES
from checks.sql import SQL


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _whole_with_nulls(values: pd.Series) -> bool:
    """Whether these are integers that became floats for the nulls among them."""
    return pd.api.types.is_float_dtype(values) and values.isna().any() and (values.dropna() % 1 == 0).all()


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(df[c]) or _whole_with_nulls(df[c]):
            df[c] = df[c].astype("Int64")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What is wrong, or None.  Values must be the same to the last bit."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = _sorted(got.copy()), _sorted(want.copy())
    for c in got.columns:
        if got[c].dtype != want[c].dtype:
            return f"{c}: {got[c].dtype} != {want[c].dtype}"
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} differ, first {got.loc[at].to_dict()} != {want.loc[at].to_dict()}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, db, wrong = session(), database(sf_dir), 0
    for name in names or QUERIES:
        begun = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - begun
            problem = difference(got, db.execute(SQL[name]).df()) if name in SQL else "no SQL"
        except Exception as error:  # noqa: BLE001
            got, spent, problem = pd.DataFrame(), time.time() - begun, f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += problem is not None
        print(f"{name:32} {spent:6.2f}s {len(got):8} rows  {problem or 'ok'}", flush=True)
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

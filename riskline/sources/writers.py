"""Sinks (A2, A3): CSV / Parquet directories written by the executors."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write ``df`` as a directory of part files (never one file through the driver)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def save_final_dataset(df: DataFrame, output_dir: str, name: str = "processed_features", fmt: str = "csv") -> str:
    """A3: write the final feature table under ``output_dir`` and return its path."""
    path = os.path.join(output_dir, f"{name}.{fmt}")
    return write_table(df, path, fmt=fmt)

"""What the operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rareflow.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not hold, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder; the shuffle files behind them are then let go.

    Spark drops a shuffle's files when the driver has collected its last reference to it, so a
    collection after each round keeps the disk at one round's shuffle and not the sum of all.
    """
    out = staged(df, label)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def by_key(batches: Iterator[pd.DataFrame], key: list[str], rows: int) -> Iterator[pd.DataFrame]:
    """Bundles of whole groups from batches of rows that are sorted by ``key``, of about ``rows`` rows."""
    kept: list[pd.DataFrame] = []
    held = 0
    for batch in batches:
        kept.append(batch)
        held += len(batch)
        if held < rows:
            continue
        whole = pd.concat(kept, ignore_index=True)
        last = np.ones(len(whole), dtype=bool)
        for k in key:
            last &= (whole[k] == whole[k].iloc[-1]).to_numpy()
        cut = int(np.argmax(last))
        if cut:
            yield whole.iloc[:cut]
        kept = [whole.iloc[cut:]]
        held = len(kept[0])
    if held:
        yield pd.concat(kept, ignore_index=True)


def smallest_in_set(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 under the links (left, right): the smallest node each can reach.

    Rounds of hooking every root below its smaller neighbour and of halving the paths; the number of
    rounds is logarithmic in the number of nodes for all but chains made to be bad.
    """
    parent = np.arange(n)
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        left, right = left[apart], right[apart]
        np.minimum.at(parent, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while not np.array_equal(parent, shorter := parent[parent]):
            parent = shorter

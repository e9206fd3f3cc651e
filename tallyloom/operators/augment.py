"""Text augmentation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.sampling import uniform

# Share of characters dropped per variant, and the share kept when
# a drop would leave nothing.
DROP_LOW, DROP_HIGH, KEEP_SHARE = 0.10, 0.20, 0.30
# bytes of text a task edits at once
PIECE = 1 << 20


def drop_chars(text: str, rate: float, seed: Sequence[int]) -> str:
    """Drop characters whose draw is at most `rate`; a text that would vanish
    keeps 30 % of its characters (at least one)."""
    if not text:
        return text
    chars = np.frombuffer(text.encode("utf-32-le"), "<u4")
    draw = np.random.default_rng(list(seed)).random(len(chars))
    kept = draw > rate
    if not kept.any():
        kept[np.argsort(-draw, kind="stable")[:max(1, int(len(chars) * KEEP_SHARE))]] = True
    return chars[kept].tobytes().decode("utf-32-le")


def edited(df: DataFrame, text: str, inputs: Sequence[str], edit: Callable[..., str]) -> DataFrame:
    """Replace `text` by `edit(text, *inputs)`; a task holds the texts of a piece of a batch as objects."""
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(ends // PIECE)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(lo, hi - lo)
                made = [edit(*values) for values in zip(*[part.column(part.schema.get_field_index(c)).to_pylist() for c in (text, *inputs)],
                                                        strict=True)]
                yield part.set_column(at, part.schema.field(at), pa.array(made, part.schema.field(at).type))

    return df.mapInArrow(run, df.schema)


def dropout_column(df: DataFrame, key: str, text: str, variant: str, rate: str, seed: int = 42) -> DataFrame:
    """Replace `text` by its dropout variant (Arrow batches; seeded by row key)."""
    return edited(df, text, [rate, key, variant], lambda t, r, k, v: drop_chars(t, r, (seed, abs(int(k)), int(v))))


def synonym_spots(text: str, synonyms: Mapping[str, Sequence[str]]) -> list:
    """(start, word) of every occurrence, overlapping ones included."""
    spots = []
    for word in synonyms:
        at = text.find(word)
        while at != -1:
            spots.append((at, word))
            at = text.find(word, at + 1)
    return spots


def synonym_replace(text: str, synonyms: Mapping[str, Sequence[str]], n: int, seed: Sequence[int]) -> str:
    """Up to n occurrences swapped, from right to left so positions stay valid."""
    spots = synonym_spots(text, synonyms)
    if not spots:
        return text
    rng = np.random.default_rng(list(seed))
    if len(spots) > n:
        spots = [spots[i] for i in rng.choice(len(spots), size=n, replace=False)]
    for at, word in sorted(spots, reverse=True):
        choice = synonyms[word][int(rng.integers(len(synonyms[word])))]
        text = text[:at] + choice + text[at + len(word):]
    return text


def synonym_column(df: DataFrame, key: str, text: str, variant: str, synonyms: Mapping[str, Sequence[str]],
                   n: int = 2, seed: int = 42) -> DataFrame:
    """Replace `text` by its synonym variant (Arrow batches; seeded by row key)."""
    words = dict(synonyms)

    return edited(df, text, [key, variant], lambda t, k, v: synonym_replace(t, words, n, (seed, abs(int(k)), int(v))))


def augment_text(df: DataFrame, key: str, text: str, keep: Sequence[str], synonyms: Mapping[str, Sequence[str]],
                 factor: int = 2, methods: Sequence[str] = ("synonym", "delete"), seed: int = 42) -> DataFrame:
    """Originals (`variant` 0) and factor-1 variants per row, methods taking
    turns by (row + variant); kept columns, the label among them, are copied."""
    base = df.select(key, text, *keep).withColumn("variant", F.lit(0)).withColumn("method", F.lit("original"))
    if factor <= 1:
        return base
    order = F.array(*[F.lit(m) for m in methods])
    many = df.select(key, text, *keep).withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(factor - 1)))) \
        .withColumn("method", F.get(order, F.pmod(F.col(key) + F.col("variant") - 1, F.lit(len(methods))).cast("int")))
    rate = F.lit(DROP_LOW) + F.lit(DROP_HIGH - DROP_LOW) * uniform(key, "variant", seed=seed)
    deleted = dropout_column(many.filter(F.col("method") == "delete").withColumn("__rate", rate), key, text, "variant",
                             "__rate", seed).drop("__rate")
    swapped = synonym_column(many.filter(F.col("method") == "synonym"), key, text, "variant", synonyms, seed=seed)
    other = many.filter(~F.col("method").isin("delete", "synonym"))
    return base.unionByName(deleted).unionByName(swapped).unionByName(other)

"""From instruction sources to a written training set."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from codeprep.functions.prompts import training_prompt
from codeprep.operators.cleaning import clean, first_wins, quality_filter
from codeprep.operators.splitting import EVAL_SHARE, SEED, sample_exact, split_exact, write_split
from codeprep.operators.tokens import MAX_TOKENS, encode, fit_vocab, tokenise
from codeprep.sources.instructions import ORDER, SOURCE_ORDER, SourceSpec, load_sources
from codeprep.staging import stage


@dataclass(frozen=True)
class DatasetConfig:
    max_samples: int | None = None
    eval_share: float = EVAL_SHARE
    seed: int = SEED
    max_tokens: int = MAX_TOKENS
    max_vocab: int | None = None
    guarded: bool = True


def prepared(samples: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Cleaned, quality-filtered rows without copies."""
    return first_wins(quality_filter(clean(samples)), order)


def training_texts(samples: DataFrame, *keep: str) -> DataFrame:
    """Training prompt per row without its end marker, which ``encode`` adds as an id.

    ``keep`` names the columns that identify a row, ``ORDER`` if it is empty.
    """
    prompt = training_prompt(F.col("instruction"), F.col("input"), F.col("output"), "")
    return samples.select(*(keep or ORDER), prompt.alias("text"))


@dataclass(frozen=True)
class SourceRows:
    """A source, whether it was loaded, and how many of its rows are left after each step."""

    name: str
    source_rank: int
    loaded: bool
    error: str | None
    rejected: tuple[tuple[str, str], ...] = ()
    n_raw: int = 0
    n_quality: int = 0
    n_dedup: int = 0
    n_sampled: int = 0
    n_train: int = 0
    n_eval: int = 0


class Steps:
    """Counts rows per source inside the jobs that write them; nothing is read again.

    A count is of the rows that passed in tasks that ended well. Where a lost executor makes
    Spark run finished tasks of a shuffle again, they are counted again.
    """

    def __init__(self, ranks: Sequence[int]):
        self.ranks, self.seen = list(ranks), {}

    def count(self, df: DataFrame, step: str, *of: Column) -> DataFrame:
        """``df``, whose rows (those that hold ``of``, if given) are counted when it is written."""
        own = [(F.col("source_rank") == rank) for rank in self.ranks]
        rules = [reduce(and_, of, rule) for rule in own]
        observed = self.seen[step] = Observation(f"{step}-{uuid.uuid4().hex}")
        return df.observe(observed, *[F.count_if(rule).alias(f"s{rank}") for rank, rule in zip(self.ranks, rules)])

    def rows(self, rank: int) -> dict[str, int]:
        """Rows of a source by step; the writing jobs must have ended."""
        return {step: observed.get[f"s{rank}"] for step, observed in self.seen.items()}


def prepared_counted(samples: DataFrame, order: Sequence[str], steps: Steps) -> DataFrame:
    """``prepared``, written, with the rows of each step counted."""
    good = steps.count(quality_filter(clean(steps.count(samples, "n_raw"))), "n_quality")
    return stage(steps.count(first_wins(good, order), "n_dedup"), "prepared")


def build_dataset(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    path: str,
    config: DatasetConfig = DatasetConfig(),
) -> list[SourceRows]:
    """Load, clean, filter, remove copies, sample, split, encode and write.

    Three tables are written on the way: the prepared samples, which the sample
    and the split read, their tokens, which the vocabulary and the encoding
    read, and the ranked vocabulary. Rows are assigned to a split by their ids before encoding, so
    the encoded arrays go straight to their place. The passes that write also
    count the rows of each source after each step. Files that cannot be read to
    their end are left out and named, see ``load_sources``.
    """
    raw, statuses = load_sources(spark, specs, config.guarded)
    steps = Steps([s.source_rank for s in statuses if s.loaded])
    samples = prepared_counted(raw, SOURCE_ORDER, steps)
    if config.max_samples:
        sample = sample_exact(samples, config.max_samples, config.seed, SOURCE_ORDER)
        samples = stage(steps.count(sample, "n_sampled"), "sampled")
    split = split_exact(samples, config.eval_share, config.seed, SOURCE_ORDER)
    ids = (*SOURCE_ORDER, "split")
    for part in ("train", "eval"):
        split = steps.count(split, f"n_{part}", F.col("split") == part)
    lines = tokenise(training_texts(split, *ids), ids)
    vocab = fit_vocab(lines, config.max_vocab)
    write_split(encode(lines, vocab, ids, config.max_tokens), path)
    report = []
    for s in statuses:
        rows = steps.rows(s.source_rank) if s.loaded else {}
        rows.setdefault("n_sampled", rows.get("n_dedup", 0))
        report.append(SourceRows(s.name, s.source_rank, s.loaded, s.error, s.rejected, **rows))
    return report

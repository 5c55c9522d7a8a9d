"""Parameters of the entry points.  0 means no limit."""

from __future__ import annotations

from dataclasses import dataclass


def check_count(name: str, value: int, least: int = 0) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < least:
        raise ValueError(f"{name} must be a whole number of {least} or more, got {value!r}")
    return value


@dataclass(frozen=True)
class RefreshParameters:
    """``embed_chars`` cuts what the model is handed, never what is hashed and
    stored.  ``max_vectors`` and ``max_objects`` are budgets of one run; what they
    defer is reported and comes next time."""

    lookback_days: int = 0
    dim: int = 1536
    embed_batch: int = 20
    embed_chars: int = 0
    max_vectors: int = 0
    retries: int = 4
    backoff_ms: int = 1024
    pause_ms: int = 0
    jitter_ms: int = 0
    calls_in_parallel: int = 0
    max_failures: int = 0
    prefix: str = "reddit/v1"
    max_objects: int = 0
    zstd_level: int = 9

    def __post_init__(self):
        for name, value in vars(self).items():
            if name != "prefix":
                check_count(name, value, 1 if name in ("dim", "embed_batch") else 0)


@dataclass(frozen=True)
class SearchParameters:
    topk: int = 10
    metadata: str = "all"
    values: bool = False
    with_text: bool = False
    lookback_days: int = 0
    max_chars: int = 0

    def __post_init__(self):
        check_count("topk", self.topk, 1)
        check_count("lookback_days", self.lookback_days)
        check_count("max_chars", self.max_chars)


@dataclass(frozen=True)
class QuestionParameters:
    topk: int = 20
    max_docs: int = 8
    dedup_threads: bool = True
    drop_missing_sid: bool = False
    doc_max_chars: int = 0
    budget: int = 0
    style: str = "numbered"

    def __post_init__(self):
        check_count("topk", self.topk, 1)
        check_count("max_docs", self.max_docs, 1)
        check_count("doc_max_chars", self.doc_max_chars)
        check_count("budget", self.budget)

"""The scores of a round: by the words that items match, or by a model, with those where the model gives none.

A scorer takes items (id, title, body, seq, ...) and gives them score and reason.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from loomsift.lineage import written
from loomsift.operators import inference, learning, render
from loomsift.operators.inference import Client

Scorer = Callable[[DataFrame], DataFrame]
BATCH = 20
# Fixed value: what stands behind the reason of an item that the model left out.
MISSED = "（llm 漏答，已降级启发式）"


def by_words(keywords: list[str], signals: list[str], domain: str) -> Scorer:
    return lambda items: render.with_reason(learning.with_score(items, keywords, signals), keywords, signals, domain)


def by_model(clients: list[Client], plain: Scorer, task: str, order: str = "seq", size: int = BATCH, root: str | None = None) -> Scorer:
    """Scores from a chain of endpoints, asked for `size` items at once in order; plain is what a batch or an item without an
    answer falls back to, so that no item is left without a score. With root, progress survives there (durable_job)."""

    def score(items: DataFrame) -> DataFrame:
        rated = written(plain(items), "scored-by-words")  # read for prompts and again for what is left out
        batches = inference.prompts(rated, order, size, task)
        replies = inference.answered(batches, clients) if root is None else inference.durable_job(batches, clients, root)
        said = inference.last_scores(replies, rated.select("id", "score", "reason"), MISSED)
        return rated.drop("score", "reason").join(said, "id")

    return score


def chosen(settings: Mapping[str, str], connect: Callable[[str, str, str], Client], plain: Scorer, task: str, order: str = "seq") -> Scorer:
    """The scorer by model if settings name an endpoint in full (llm_base_url, llm_api_key, llm_model; llm_batch_size is
    optional), else the plain one. connect makes a client of the three."""
    endpoint = [settings.get(k, "") for k in ("llm_base_url", "llm_api_key", "llm_model")]
    if not all(endpoint):
        return plain
    size = settings.get("llm_batch_size", "")
    return by_model([connect(*endpoint)], plain, task, order, int(size) if size.isdigit() and int(size) else BATCH)

"""User-supplied batch model that describes figures; the only Python that sees rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as t

from leafmill.scratch import settle

# Fixed value: the default instruction handed to the model.
PROMPT = "Describe this image from an electronics datasheet."
BATCH = 64

Model = Callable[[str, list[str]], list[str]]


def answers(describe: Model, prompt: str, images: list[str]) -> list[tuple[str, str | None]]:
    """(response, error) of each image: one call, halved where it fails until only the culprits are left."""
    try:
        told = describe(prompt, images)
        if len(told) != len(images):
            raise ValueError(f"{len(told)} responses to {len(images)} images")
        return [((x or "").strip(), None) for x in told]
    except Exception as error:  # noqa: BLE001 - any model error means "no description"
        if len(images) == 1:
            return [("", f"{type(error).__name__}: {error}")]
        half = len(images) // 2
        return answers(describe, prompt, images[:half]) + answers(describe, prompt, images[half:])


def describe_figures(
    figures: DataFrame,
    load_model: Callable[[], Model],
    *,
    prompt: str = PROMPT,
    image: str = "image_path",
    batch_size: int = BATCH,
) -> DataFrame:
    """Add ``response`` and ``error`` by calling a model on batches of the figures' image column.

    ``load_model`` runs once per task and returns ``describe(prompt, images)``, which gives one text
    per image, in order.  A call that fails is halved: one bad image in a batch of n costs some
    2 log2(n) further calls, and it alone gets an empty response, which triage treats as missing, and
    the message in ``error``.
    """
    added = [t.StructField(c, t.StringType()) for c in ("response", "error")]
    schema = t.StructType([*figures.schema.fields, *added])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        describe = load_model()
        for batch in batches:
            images = batch[image].tolist()
            told = [x for k in range(0, len(images), batch_size) for x in answers(describe, prompt, images[k : k + batch_size])]
            yield batch.assign(response=[r for r, _ in told], error=pd.Series([e for _, e in told], batch.index, object))

    return figures.mapInPandas(run, schema)


def settled_responses(
    figures: DataFrame,
    load_model: Callable[[], Model],
    *,
    prompt: str = PROMPT,
    image: str = "image_path",
    batch_size: int = BATCH,
) -> DataFrame:
    """(doc_id, figure_id, response, error), asked once for each figure and written before it is used.

    A plan that reads a description twice would otherwise run the model twice, and a model that
    isn't deterministic would contradict itself.
    """
    rows = figures.select("doc_id", "figure_id", image)
    asked = describe_figures(rows, load_model, prompt=prompt, image=image, batch_size=batch_size)
    return settle(asked.select("doc_id", "figure_id", "response", "error"), "responses")

"""Model calls: text completion and embedding, with the model injected as a plain callable.

Only the prompt or text column crosses to Python, in Arrow batches; all other columns stay in the JVM. Of a batch, whose
size Spark limits, only a few hundred texts at a time become Python strings. Write the result out before using it twice: an answer may differ when it is computed again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StringType

from ..functions.responses import FAILURE_PREFIX, parse_responses
from ..functions.text import normalize_date, reference_text, render_prompt

# The prompt used when the caller brings no template.
DEFAULT_TEMPLATE = (
    "Which companies does this article report on, and what kind of event is it? Answer with one JSON object: "
    '{{"results": {{"id", "company_names", "classification", "category", "summary"}}}}.\n\n'
    "ID: {Id}\nDate: {date}\nTitle: {title}\nContent: {content}\n"
)

# Texts of an Arrow batch that are Python strings at the same time, at least.
_TEXTS = 256
_VECTOR = pa.list_(pa.field("element", pa.float32()))


def _slices(batches: Iterator[pa.Array], rows: int) -> Iterator[tuple[pa.Array, Iterator[list[str | None]]]]:
    """Each batch, with its texts as lists of ``rows`` of them."""
    for batch in batches:
        yield batch, (batch.slice(start, rows).to_pylist() for start in range(0, len(batch), rows))


def article_prompt(template: str = DEFAULT_TEMPLATE):
    """Prompt column of an article; a template with unknown slots falls back to the default."""
    fields = {"Id": "seq", "date": "basc_dt", "title": "title", "content": "content"}
    try:
        return render_prompt(template, **fields)
    except (KeyError, ValueError):
        return render_prompt(DEFAULT_TEMPLATE, **fields)


def complete(
    df: DataFrame,
    prompt: str,
    call: Callable[[str], str],
    out: str = "raw_content",
    concurrency: int = 50,
    tasks: int | None = None,
) -> DataFrame:
    """Add the model's answer to each prompt; at most ``concurrency`` calls run at once in all tasks together.

    Rows are spread evenly over ``tasks`` tasks (the session's parallelism unless given, and never more than calls
    may run), each of which has its share of the calls. A call that raises gives the text
    ``Failure: API calling: ...`` for its own row only.
    """
    tasks = max(1, min(tasks or df.sparkSession.sparkContext.defaultParallelism, concurrency))
    share = max(1, concurrency // tasks)

    def answer(text: str) -> str:
        try:
            return call(text)
        except Exception as error:
            return f"{FAILURE_PREFIX} API calling: {error}"

    def answer_next(todo: Iterator[tuple[int, str]], out: list) -> None:
        for k, text in todo:  # all threads take from one iterator
            out[k] = answer(text)

    @F.arrow_udf(StringType())
    def answers(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with ThreadPoolExecutor(share) as pool:
            for batch, parts in _slices(batches, max(_TEXTS, 64 * share)):
                made: list[str | None] = []
                for texts in parts:
                    out, todo = [None] * len(texts), iter(list(enumerate(texts)))
                    for done in [pool.submit(answer_next, todo, out) for _ in range(share)]:
                        done.result()
                    made += out
                yield pa.array(made, pa.string())

    return df.repartition(tasks).withColumn(out, answers.asNondeterministic()(F.col(prompt)))


def extract_articles(
    articles: DataFrame,
    call: Callable[[str], str],
    template: str = DEFAULT_TEMPLATE,
    concurrency: int = 50,
    tasks: int | None = None,
) -> DataFrame:
    """Articles with company names, class, category and summary from the model.

    One answer per article row, also where a number occurs twice. Dates are normalised and the
    reference line is built here. Calls are spread and bounded as in :func:`complete`; a model call takes far
    longer than moving its article.
    """
    prompted = articles.withColumn("_prompt", article_prompt(template))
    parsed = parse_responses(complete(prompted, "_prompt", call, concurrency=concurrency, tasks=tasks).drop("_prompt"))
    return parsed.withColumn("basc_dt", normalize_date("basc_dt")).withColumn(
        "reference", reference_text("title", "basc_dt", "site_name")
    )


def embed(
    df: DataFrame,
    text: str,
    encode: Callable[[list[str]], object],
    encoder_id: str,
    out: str = "embedding",
    batch_size: int = 64,
    tasks: int | None = None,
    window_chars: int | None = None,
) -> DataFrame:
    """Add the embedding of a text column and the id of the encoder that made it; null counts as ''.

    Rows are spread evenly over ``tasks`` tasks (the session's parallelism unless given). For a model that reads
    only so many characters, ``window_chars`` cuts a text into consecutive windows of that size, and its vector is
    the mean of theirs weighted by length, so all of the text counts.
    """

    def windows(text: str) -> list[str]:
        size = window_chars or max(len(text), 1)
        return [text[k : k + size] for k in range(0, max(len(text), 1), size)]

    def encoded(texts: list[str | None]) -> list[np.ndarray]:
        cut = [windows("" if t is None else t) for t in texts]
        values = [w for ws in cut for w in ws]
        rows: list[np.ndarray] = []
        for start in range(0, len(values), batch_size):
            rows.extend(np.asarray(encode(values[start : start + batch_size]), dtype=np.float32))
        made, at = [], 0
        for ws in cut:
            part = rows[at : at + len(ws)]
            weight = [max(len(w), 1) for w in ws]
            made.append(part[0] if len(ws) == 1 else np.average(part, axis=0, weights=weight).astype(np.float32))
            at += len(ws)
        return made

    @F.arrow_udf(ArrayType(FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch, parts in _slices(batches, max(_TEXTS, batch_size)):
            made = [v for texts in parts for v in encoded(texts)]
            ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
            flat = np.concatenate(made) if made else np.zeros(0, np.float32)
            yield pa.ListArray.from_arrays(ends, flat, type=_VECTOR)

    df = df.repartition(max(1, tasks or df.sparkSession.sparkContext.defaultParallelism))
    embedded = df.withColumn(out, vectors.asNondeterministic()(F.col(text)))
    return embedded.withColumn("encoder_id", F.lit(encoder_id))

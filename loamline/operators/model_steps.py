"""Steps that ask a model, a search service or a job server: the data side of them, with the service as a function.

A service is any function of plain values. It runs in the workers, one call a row, within Arrow batches; what fails has a
defined result, so that one bad answer does not end a run. Tests and offline runs hand in functions of their own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from loamline.functions.urls import normalise_url
from loamline.operators.retrieval import SOURCE_BOOST
from loamline.operators.sql_guard import extract_statements

FAILED = -1.0
MAX_SCORED_CHARS = 2_000


def rerank_with(hits: DataFrame, score: Callable[[str, str], float], question: str, text: str, source: str, query: str, k: int) -> DataFrame:
    """The k best hits of each query by a judge's score (0 to 1) and the boost of their source; a judge that fails or answers
    no number gives FAILED, without a boost. Ties keep the order of the former rank."""

    @F.pandas_udf(DoubleType())
    def judged(questions: pd.Series, texts: pd.Series) -> pd.Series:
        def one(q: str, t: str) -> float:
            try:
                return float(score(q or "", (t or "")[:MAX_SCORED_CHARS]))
            except Exception:  # noqa: BLE001
                return FAILED

        return pd.Series([one(q, t) for q, t in zip(questions, texts)], dtype="float64")

    boost = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in SOURCE_BOOST.items() for x in p]), F.lower(F.coalesce(F.col(source), F.lit("")))), F.lit(0.0))
    scored = hits.withColumn("model_score", judged(F.col(question), F.col(text)))
    scored = scored.withColumn("rerank_score", F.when(F.col("model_score") >= 0, F.col("model_score") + boost).otherwise(F.col("model_score")))
    w = Window.partitionBy(query).orderBy(F.desc("rerank_score"), "rank")
    return scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("rank").withColumnRenamed("_r", "rank")


def generate_with(contexts: DataFrame, answer: Callable[[str, str], str | None] | None, question: str, context: str, out: str = "answer") -> DataFrame:
    """Answers to questions from their contexts; without a generator, or where it fails or says nothing, the context stands in."""

    @F.pandas_udf(StringType())
    def answered(questions: pd.Series, contexts: pd.Series) -> pd.Series:
        def one(q: str, c: str) -> str:
            try:
                said = answer(q or "", c or "") if answer else None
            except Exception:  # noqa: BLE001
                said = None
            return said.strip() if said and said.strip() else f"No answer was generated. Context:\n{c or ''}"

        return pd.Series([one(q, c) for q, c in zip(questions, contexts)], dtype=object)

    return contexts.withColumn(out, answered(F.col(question), F.col(context)))


def statements_for(question: str, hints: list[str], write: Callable[[str], str], *, each: bool = True, most: int = 10) -> list[str]:
    """SQL that a writer makes of a question and hints about tables, one prompt a hint or one for all; statements that differ in
    blanks only count once. Runs where plans are made: a question and a few hints, no data."""
    prompt = lambda part: f"Question: {question}\n\nTables:\n{part}\n\nAnswer with one SELECT statement only."
    prompts = [prompt(h) for h in hints] if each else [prompt("\n\n".join(hints))]
    found: dict[str, str] = {}
    for p in prompts:
        try:
            said = write(p)
        except Exception:  # noqa: BLE001, S112
            continue
        for s in extract_statements(said or "", most):
            found.setdefault(" ".join(s.split()), s)
    return list(found.values())[:most]


def first_that_helps(rows: DataFrame, stages: list[tuple[str, str]], least_chars: int, out: str = "body", tag: str = "body_source") -> DataFrame:
    """A cascade of providers: ``out`` is the first of the columns ``[(tag, column)]`` whose text has ``least_chars`` characters, and
    ``tag`` says whose it is; null and an empty tag where none has."""
    long_enough = lambda c: F.length(F.trim(F.coalesce(F.col(c), F.lit("")))) >= least_chars
    body, said = F, F
    for name, column in stages:
        body, said = body.when(long_enough(column), F.col(column)), said.when(long_enough(column), F.lit(name))
    return rows.withColumns({out: body.otherwise(F.lit(None).cast("string")), tag: said.otherwise("")})


def fetched(items: DataFrame, url: str, fetch: Callable[[str], str | None], out: str = "html") -> DataFrame:
    """Items with what each address holds; null where fetching fails. Addresses are fetched once however many items name them."""

    @F.pandas_udf(StringType())
    def load(urls: pd.Series) -> pd.Series:
        def one(u: str | None) -> str | None:
            try:
                return fetch(u) if u else None
            except Exception:  # noqa: BLE001
                return None

        return pd.Series([one(u) for u in urls], dtype=object)

    pages = items.select(F.col(url).alias("_u")).where(F.col("_u").isNotNull()).distinct().withColumn(out, load("_u"))
    return items.join(pages, items[url] == pages["_u"], "left").drop("_u")


def searched(queries: DataFrame, query: str, search: Callable[[str], list[dict]]) -> DataFrame:
    """``(query, url, title, content)`` of a search service, each page once over all queries: the first query by name has it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for q in batch[query]:
                try:
                    rows += [(q, h.get("url"), h.get("title"), h.get("content")) for h in search(q) or []]
                except Exception:  # noqa: BLE001, S112
                    continue
            yield pd.DataFrame(rows, columns=["query", "url", "title", "content"])

    found = queries.select(query).where(F.col(query).isNotNull()).mapInPandas(run, "query string, url string, title string, content string")
    found = found.where(F.trim(F.coalesce("url", F.lit(""))) != "").withColumn("_k", normalise_url("url", same_scheme=True))
    return found.groupBy("_k").agg(F.min(F.struct("query", "url", "title", "content")).alias("h")).select("h.*")


def research(question: str, search: Callable[[str], list[str]], next_query: Callable[[str, list[str]], str | None], compress: Callable[[str, list[str]], str], *, rounds: int = 4, chars: int = 8_000) -> str:
    """A research loop: notes are gathered query by query until there is no next one or the rounds or characters are used up, then
    compressed. A search that fails adds nothing."""
    notes: list[str] = []
    asked: str | None = question
    for _ in range(rounds):
        if not asked or sum(map(len, notes)) >= chars:
            break
        try:
            notes += [n for n in search(asked) if n and n not in notes]
        except Exception:  # noqa: BLE001, S110
            pass
        asked = next_query(question, notes)
    return compress(question, notes) if notes else ""


# States in which a job of the connector server has ended, and those of them that are a success.
ENDED, SUCCEEDED = {"succeeded", "completed", "failed", "cancelled", "incomplete", "error"}, {"succeeded", "completed"}


def run_job(start: Callable[[], str], status: Callable[[str], str], *, timeout: float = 7_200, every: float = 10, sleep: Callable[[float], None] = time.sleep) -> str:
    """Starts a job and asks after it until it ends; its last state. An error where it fails or does not end in time."""
    job, waited = start(), 0.0
    while True:
        state = status(job).strip().lower()
        if state in ENDED:
            break
        if waited >= timeout:
            raise TimeoutError(f"job {job} is {state} after {waited:.0f} s")
        sleep(every)
        waited += every
    if state not in SUCCEEDED:
        raise RuntimeError(f"job {job} ended as {state}")
    return state


def changed_files(listing: DataFrame, manifest: DataFrame, suffixes: list[str] | None = None) -> DataFrame:
    """``listing (path, md5, size)`` with ``action``: ``download`` where the manifest lacks the file, or knows another md5 or size,
    ``skip`` otherwise and where its suffix is not wanted. Unknown md5 or size of the listing decide nothing."""
    known = manifest.groupBy("path").agg(F.max_by(F.struct(F.col("md5").alias("m"), F.col("size").alias("s")), F.struct("md5", "size")).alias("_k"))
    wanted = F.lower("path").rlike("(" + "|".join(s.lower().replace(".", r"\.") for s in suffixes) + ")$") if suffixes else F.lit(True)
    other = lambda a, b: a.isNotNull() & ~a.eqNullSafe(b)
    new = F.col("_k").isNull() | other(F.col("md5"), F.col("_k.m")) | other(F.col("size"), F.col("_k.s"))
    return listing.join(known, "path", "left").select("path", "md5", "size", F.when(wanted & new, "download").otherwise("skip").alias("action"))


def layout_blocks(content: bytes, name: str) -> list[str] | None:
    """Blocks of a document by a layout partitioner, where the package is installed; else None, and the readers' plain text stands."""
    try:
        import io

        from unstructured.partition.auto import partition
    except ImportError:
        return None
    return [str(e) for e in partition(file=io.BytesIO(content), metadata_filename=name)]

"""Model-backed extraction: prompt fan-out, pluggable client, response parsing and fallbacks.

The client is called in one place, a map over (chunk, prompt) rows; its responses
are a table, so everything after it is a plain plan and can run offline.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import col, truncate, words

#: fixed values: the lists an entity response may hold
ENTITY_KEYS = ("events", "actors", "concepts", "publications", "locations", "relationships")
FENCE = "```"


def prompt_rows(chunks: DataFrame, prompts: dict[str, str], key: str = "chunk_id", text: str = "text") -> DataFrame:
    """(key, entity_type, prompt): every chunk with every template; '{text}' stands for the chunk's text."""
    table = F.array(*(F.struct(F.lit(k).alias("entity_type"), F.lit(v).alias("template")) for k, v in prompts.items()))
    return chunks.select(key, F.col(text).alias("_t"), F.explode(table).alias("p")).select(
        key, "p.entity_type", F.replace(F.col("p.template"), F.lit("{text}"), F.coalesce("_t", F.lit(""))).alias("prompt")
    )


def call_model(rows: DataFrame, client: Callable[[], Callable[[str], str]], prompt: str = "prompt", calls_per_second: float | None = None) -> DataFrame:
    """Rows with ``response`` and ``error``: one call per row, errors become values.

    ``client`` makes a callable on each worker; the limit holds per partition, so
    repartition to the number of parallel callers first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for pdf in batches:
            answers, errors = [], []
            for p in pdf[prompt]:
                begin = time.monotonic()
                try:
                    answers.append(ask(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    answers.append(None)
                    errors.append(str(e)[:500])
                if calls_per_second:
                    time.sleep(max(0.0, 1 / calls_per_second - (time.monotonic() - begin)))
            yield pdf.assign(response=answers, error=errors)

    ddl = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", response string, error string"
    return rows.mapInPandas(run, ddl)


def json_body(response) -> Column:
    """The JSON object in a response: the content of a code fence, or the text, from the first '{' to the last '}'."""
    r = col(response)
    fenced = F.regexp_extract(r, rf"(?s){FENCE}(?:json)?\s*(.*?){FENCE}", 1)
    body = F.when(fenced != "", fenced).otherwise(r)
    return F.regexp_extract(body, r"(?s)(\{.*\})", 1)


def parse_response(response, ddl: str) -> Column:
    """The response as a typed struct; null when it is no such JSON."""
    body = json_body(response)
    return F.when((body != "") & F.is_valid_utf8(body), F.from_json(body, ddl, {"mode": "PERMISSIVE"}))


def degraded_keys(response) -> Column:
    """Of a response that does not parse: the entity lists it at least names, else null."""
    named = F.array_compact(F.array(*(F.when(col(response).contains(f'"{k}"'), F.lit(k)) for k in ENTITY_KEYS)))
    return F.when(F.size(named) > 0, named)


def error_text(response, n: int = 500) -> Column:
    return F.left(F.coalesce(col(response), F.lit("")), F.lit(n))


def supporting_text(name, year, text, kind: Column, limit: int = 200) -> Column:
    """Sentences that support an entity: the first two that fit, else the beginning of the text.

    A name of several words fits a sentence that holds two of its words of more
    than three letters, or the year; a single word must occur, for events together
    with the year.
    """
    t, nm = col(text), F.lower(F.coalesce(col(name), F.lit("")))
    y = col(year).cast("string")
    long = F.filter(words(nm), lambda w: F.char_length(w) > 3)
    has_year = lambda s: F.coalesce(s.contains(y), F.lit(False))
    sentences = F.split(t, r"\. ")

    def fits(s: Column) -> Column:
        low = F.lower(s)
        many = (F.size(F.filter(long, lambda w: low.contains(w))) >= 2) | has_year(s)
        one = (nm != "") & low.contains(nm) & (F.when(kind == "event", has_year(s)).otherwise(F.lit(True)))
        return F.when(F.size(words(nm)) > 1, many).otherwise(one)

    got = F.slice(F.filter(sentences, fits), 1, 2)
    return F.when(F.size(got) > 0, F.array_join(got, ". ")).otherwise(truncate(t, limit))

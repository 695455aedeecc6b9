"""Calls of language models over rows: backends, retries, checkpoints, rescue.

A backend is a function from a prompt to a reply. `stub_backend` stands in where no model is served: its replies depend
on nothing but the prompt.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from trovespark.functions.answers import checked_answer
from trovespark.operators.ranking import upserted
from trovespark.plans.config import endpoint, thinking

Backend = Callable[[str], str]
# What a busy or broken server says.
BUSY = (429, 502, 503, 504)


def stub_backend(prompt: str) -> str:
    """A stand-in reply that depends on the prompt alone: two facts, one sentence, or an answer, by what is asked for."""
    mark = hashlib.md5(prompt.encode()).hexdigest()[:8]
    replies = {
        '"claims"': lambda: json.dumps({"claims": [f"Fact {mark} is the first of two.", f"Fact {mark} has a second part."]}),
        "one sentence": lambda: f"Everything said under {mark} in one sentence.",
    }
    made = next((make for asked, make in replies.items() if asked in prompt), lambda: json.dumps({"ideal_answer": "Mock answer.", "evidence_ids": []}))
    return made()


def http_backend(url: str, model: str, chat: bool = False, key_variable: str = "LLM_API_KEY", timeout: float = 120.0, think: str | None = None, **options) -> Backend:
    """A backend over HTTP: a generate endpoint, or a chat completions endpoint. `url` is the server's address or the
    endpoint's; `think` goes along where it is set. The key comes from the environment."""
    place, asked = endpoint(url, "v1/chat/completions" if chat else "api/generate"), {} if (t := thinking(think)) is None else {"think": t}

    def call(prompt: str) -> str:
        body = {"model": model, "messages": [{"role": "user", "content": prompt}], **asked, **options} if chat else {"model": model, "prompt": prompt, "stream": False, **asked, "options": options}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {os.environ[key_variable]}"} if os.environ.get(key_variable) else {})
        with urllib.request.urlopen(urllib.request.Request(place, json.dumps(body).encode(), headers), timeout=timeout) as reply:
            found = json.load(reply)
        return found["choices"][0]["message"]["content"] if chat else found["response"]

    return call


def worth_retrying(error: Exception) -> bool:
    """Timeouts, lost connections and busy servers."""
    return getattr(error, "code", None) in BUSY or isinstance(error, (TimeoutError, ConnectionError)) or (isinstance(error, OSError) and not hasattr(error, "code"))


def replied(prompts: DataFrame, backend: Backend = stub_backend, attempts: int = 3, wait: float = 1.0) -> DataFrame:
    """`prompts` with reply and error. Only errors worth it are retried; a call that succeeds has no error."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prompts.schema) + ", reply string, error string"

    def ask(prompt: str | None) -> tuple[str | None, str | None]:
        if not (prompt or "").strip():
            return None, "empty prompt"
        for attempt in range(attempts):
            try:
                return backend(prompt), None
            except Exception as e:
                if not worth_retrying(e) or attempt + 1 == attempts:
                    return None, f"{type(e).__name__}: {e}"
                time.sleep(wait * 2**attempt)
        return None, "no attempt"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            both = [ask(p) for p in pdf["prompt"]]
            yield pdf.assign(reply=[r for r, _ in both], error=[e for _, e in both])

    return prompts.mapInPandas(run, schema)


def answers(records: DataFrame, backend: Backend = stub_backend, attempts: int = 3) -> DataFrame:
    """`records` (query_id, query_type, prompt, n_contexts, …) with ideal_answer, evidence_ids, exact_yesno, exact_list
    and error. Records without a prompt or contexts are errors; a reply that doesn't parse is one and isn't retried."""
    ready = records.withColumn("prompt", F.when(F.col("n_contexts") > 0, F.col("prompt")))
    told = replied(ready, backend, attempts)
    names = ("ideal_answer", "evidence_ids", "exact_yesno", "exact_list")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in told.schema if f.name != "reply") + ", ideal_answer string, evidence_ids array<string>, exact_yesno string, exact_list array<array<string>>"

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for reply, kind, error in zip(pdf["reply"], pdf["query_type"], pdf["error"]):
                try:
                    rows.append({"error": error} if error else checked_answer(reply, kind) | {"error": None})
                except ValueError as e:
                    rows.append({"error": str(e)})
            for name in (*names, "error"):
                pdf[name] = pd.Series([r.get(name) for r in rows], dtype=object, index=pdf.index)
            yield pdf.drop(columns="reply")

    return told.mapInPandas(parse, schema)


def fingerprint(*settings: str | int | None) -> str:
    """A name for a run's settings: rows made under other settings aren't reused."""
    return hashlib.sha1("\0".join(map(str, settings)).encode()).hexdigest()[:16]


def to_do(records: DataFrame, done: DataFrame, run: str) -> DataFrame:
    """Records without a clean answer of this run."""
    return records.join(done.where((F.col("run") == run) & F.col("error").isNull()).select("query_id"), "query_id", "left_anti")


def failed(answered: DataFrame, only_timeouts: bool = False) -> DataFrame:
    """Answers with an error, or only those that a gateway timed out."""
    rows = answered.where(F.coalesce(F.col("error"), F.lit("")) != "")
    return rows.where(F.col("error").contains("504")) if only_timeouts else rows


def rescued(answered: DataFrame, backend: Backend = stub_backend, only_timeouts: bool = False) -> DataFrame:
    """Failed answers asked again and put in the old ones' place."""
    again = answers(failed(answered, only_timeouts).drop("ideal_answer", "evidence_ids", "exact_yesno", "exact_list", "error"), backend)
    return upserted(answered, again.select(*answered.columns))


def unanswered(answered: DataFrame) -> DataFrame:
    """query_id, prompt and error of what still fails, to be looked at by hand."""
    return failed(answered).select("query_id", "prompt", "error")


def worst_prompt(words: Column) -> Column:
    """The most tokens that any prompt may take."""
    return F.max(words * 1.4 + 800)


def preflight(prompts: DataFrame, words: Column, context: int, share: float = 0.75) -> DataFrame:
    """One row: the most tokens that a prompt may take, and whether that fits the share of the model's context."""
    return prompts.agg(worst_prompt(words).alias("most_tokens")).withColumn("fits", F.col("most_tokens") <= share * context)

"""Completion of prompts: any function from messages to text, applied by partition."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.functions.text import messages, prompt_context, user_prompt

Completion = Callable[[list[dict[str, str]]], str]


@dataclass
class Config:
    """Settings of a completion service."""

    api_key: str
    base_url: str = ""
    model: str = ""
    timeout: float = 60.0
    max_tokens: int = 700
    temperature: float = 0.2

    @classmethod
    def from_env(cls, prefix: str = "COMPLETION_", env: dict[str, str] | None = None) -> Config:
        """Settings from <prefix>API_KEY, BASE_URL, MODEL, TIMEOUT, MAX_TOKENS, TEMPERATURE; a missing key is an error."""
        found = os.environ if env is None else env
        if not found.get(f"{prefix}API_KEY"):
            raise ValueError(f"{prefix}API_KEY is not set")
        own = {"api_key": found[f"{prefix}API_KEY"]}
        for name, kind in (("base_url", str), ("model", str), ("timeout", float), ("max_tokens", int), ("temperature", float)):
            if value := found.get(prefix + name.upper()):
                own[name] = kind(value)
        return cls(**own)


def offline(found: list[dict[str, str]]) -> str:
    """A deterministic stand-in where there is no service: says what it was asked and how much data came along."""
    user = next((m["content"] for m in found if m["role"] == "user"), "")
    return f"{user.splitlines()[0] if user else ''} ({len(user)} characters of data)"


def complete(df: DataFrame, function: Completion = offline, column: str = "messages", out: str = "completion") -> DataFrame:
    """df with the completion of its messages (array of role and content). The function is sent to the tasks; null messages stay null."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part[out] = [function(json.loads(m)) if isinstance(m, str) else None for m in part[column]]
            yield part

    flat = df.select(F.to_json(column).alias(column), *(c for c in df.columns if c != column))
    schema = T.StructType([*flat.schema.fields, T.StructField(out, T.StringType())])
    return flat.mapInPandas(run, schema).withColumn(column, F.from_json(column, "array<struct<role:string,content:string>>"))


def describe(contexts: DataFrame, function: Completion = offline, files: DataFrame | None = None) -> DataFrame:
    """(accession, prompt, messages, completion) for contexts (accession, context); a context without a protein is an error at that row."""
    return describe_sampled(contexts.withColumn("context", prompt_context(F.col("context"))), function, files)


def describe_sampled(contexts: DataFrame, function: Completion = offline, files: DataFrame | None = None) -> DataFrame:
    """describe, for contexts of which only the counts and samples that a prompt shows are there."""
    found = contexts if files is None else contexts.join(files, "accession", "left")
    manifest = F.col("files") if files is not None else F.lit(None).cast("array<string>")
    known = found.withColumn("context", F.when(F.col("context.protein").isNotNull(), F.col("context")).otherwise(F.raise_error(F.concat(F.lit("not in the graph: "), "accession")).cast(found.schema["context"].dataType)))
    prompted = known.select("accession", user_prompt(F.col("accession"), F.col("context"), manifest).alias("prompt"))
    return complete(prompted.withColumn("messages", messages(F.col("prompt"))), function)

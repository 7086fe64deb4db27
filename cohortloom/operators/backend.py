"""Pluggable inference: a batch function at the end of a plan, errors as data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import without_fence

Generate = Callable[[list[str]], list[str | None]]


def run_backend(df: DataFrame, id_col: str, prompt_col: str, generate: Generate, batch: int = 500) -> DataFrame:
    """(id, output, error): one row per input; a batch that fails is retried row by row, and a row that fails carries its message."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for s in range(0, len(b), batch):
                part = b.iloc[s : s + batch]
                prompts = [p if isinstance(p, str) else None for p in part["p"]]
                try:
                    rows = [(o, None) for o in generate(prompts)]
                except Exception:
                    rows = []
                    for p in prompts:
                        try:
                            rows.append((generate([p])[0], None))
                        except Exception as e:
                            rows.append((None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame({"id": part["id"], "output": [r[0] for r in rows], "error": [r[1] for r in rows]})

    return df.select(F.col(id_col).alias("id"), F.col(prompt_col).alias("p")).mapInPandas(run, f"id {kind}, output string, error string").withColumnRenamed("id", id_col)


def mock_reply(record_id: Column, text: Column, fail: list[str], as_json: bool = True) -> dict[str, Column]:
    """Replies of the mock backend as expressions: an echo of the first 80 characters, or a failure for the named ids."""
    echo = F.substring(F.coalesce(text, F.lit("")), 1, 80)
    failed = record_id.cast("string").isin(*fail) if fail else F.lit(False)
    output = F.to_json(F.struct(record_id.alias("record_id"), echo.alias("echo"))) if as_json else echo
    return {"output": F.when(~failed, output), "error": F.when(failed, F.lit("forced failure"))}


def reply_class(finish: Column, content: Column) -> Column:
    """Kind of a provider's reply: truncated, empty, not_json or ok."""
    return F.when(finish == "length", "truncated").when(F.coalesce(F.trim(content), F.lit("")) == "", "empty").when(F.try_parse_json(content).isNull(), "not_json").otherwise("ok")


def many_models(df: DataFrame, id_col: str, prompt_col: str, models: dict[str, Generate], batch: int = 500) -> DataFrame:
    """(id, model, output, error): every input under every model; a row that fails under one model doesn't touch the others."""
    each = df.select(F.col(id_col), F.col(prompt_col).alias("_p"), F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    parts = [run_backend(each.filter(F.col("model") == m), id_col, "_p", g, batch).withColumn("model", F.lit(m)) for m, g in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(id_col, "model", "output", "error")


def rerun_failed(df: DataFrame, done: DataFrame, id_col: str, prompt_col: str, instruction: str, generate: Generate) -> DataFrame:
    """(id, output, error): the failed rows of ``done`` asked again with an instruction at the end of their prompt; the others as they are."""
    failed = df.join(done.filter("error is not null").select(id_col), id_col, "left_semi")
    again = run_backend(failed.withColumn("_more", F.concat(prompt_col, F.lit("\n\n" + instruction))), id_col, "_more", generate)
    return done.filter("error is null").unionByName(again)


#: By provider: paths of content, finish reason and both token counts in a reply, and whether system messages stand apart.
PROVIDERS = {
    "chat": ("$.choices[0].message.content", "$.choices[0].finish_reason", "$.usage.prompt_tokens", "$.usage.completion_tokens", False),
    "blocks": ("$.content[0].text", "$.stop_reason", "$.usage.input_tokens", "$.usage.output_tokens", True),
}


def request_body(provider: str, model: Column, system: Column, user: Column, max_tokens: int, temperature: float = 0.0) -> Column:
    """The JSON body of a request; a provider that keeps system messages apart gets them as a field of their own."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    settings = [F.lit(max_tokens).alias("max_tokens"), F.lit(temperature).alias("temperature")]
    if PROVIDERS[provider][4]:
        return F.to_json(F.struct(model.alias("model"), system.alias("system"), F.array(message("user", user)).alias("messages"), *settings))
    return F.to_json(F.struct(model.alias("model"), F.array(message("system", system), message("user", user)).alias("messages"), *settings))


def reply_fields(provider: str, reply: Column) -> dict[str, Column]:
    """Content without a fence, finish reason and token counts of a provider's reply; absent fields are null."""
    content, finish, n_in, n_out, _ = PROVIDERS[provider]
    get = lambda p: F.get_json_object(reply, p)
    return {"content": without_fence(get(content)), "finish": get(finish), "input_tokens": get(n_in).try_cast("long"), "output_tokens": get(n_out).try_cast("long")}

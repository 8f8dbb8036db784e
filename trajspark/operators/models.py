"""The rate table as columns: a literal array, so no join and no shuffle is needed."""

from pyspark.sql import DataFrame, functions as F

from trajspark.operators.tokens import per_encoding, tokens_column


def _quoted(text):
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _config(model):
    return (f"'encoding', {_quoted(model.encoding)}, "
            f"'supports_vision', {'true' if model.supports_vision else 'false'}, "
            f"'input_price_per_1m', {float(model.input_price_per_1m)!r}D, "
            f"'output_price_per_1m', {float(model.output_price_per_1m)!r}D, "
            f"'image_token_multiplier', {float(model.image_token_multiplier)!r}D")


def with_models(rows: DataFrame, models, keys=None, counters=None) -> DataFrame:
    """One row per input row and model, with the model's label and configuration.

    If the rows carry text_tokens_<i>, `text_tokens` is the count of the model's encoding.
    """
    distinct, position = per_encoding(models, counters)
    entries = ", ".join(
        f"named_struct('model', {_quoted(name)}, 'counter', {position[m.encoding]}, {_config(m)})"
        for name, m in models.items())
    out = rows.select(*(keys or ["*"]), F.expr(f"inline(array({entries}))"))
    texts = [tokens_column(i) for i in range(len(distinct))]
    if all(t in rows.columns for t in texts):
        out = out.withColumn("text_tokens", F.expr(
            texts[0] if len(texts) == 1
            else "CASE counter " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts))
            + " END")).drop(*texts)
    return out.drop("counter")


def with_config(rows: DataFrame, models) -> DataFrame:
    """Adds the configuration of each row's `model`; an unknown label fails the query."""
    cases = " ".join(f"WHEN {_quoted(name)} THEN named_struct({_config(m)})"
                     for name, m in models.items())
    return rows.withColumn("_config", F.expr(
        f"CASE model {cases} ELSE raise_error(concat('no rates for model ', model)) END")).select(
        "*", "_config.*").drop("_config")


def pricing(input_tokens, output_tokens):
    """SQL text of struct<input_cost, output_cost, total_cost> in binary doubles."""
    input_cost = f"({input_tokens}) / 1000000.0D * input_price_per_1m"
    output_cost = f"({output_tokens}) / 1000000.0D * output_price_per_1m"
    return (f"named_struct('input_cost', {input_cost}, 'output_cost', {output_cost}, "
            f"'total_cost', {input_cost} + {output_cost})")

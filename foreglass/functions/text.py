"""Texts of prompts, rationales and model outputs as column expressions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from foreglass.functions import loosejson

# Phrases that give the original rationale away, in this order, and what replaces them.
GIVEAWAYS = ("vanilla rationale", "original rationale", "vanilla reasoning", "original reasoning")
REPLACEMENT = "given context"
RATIONALE_FIELDS = ("source_analysis", "market_analysis", "rationale")
PRICE_FIELDS = ("yes_ask", "yes_bid", "no_ask", "no_bid", "liquidity")
#: Text for an outcome list that can't be read.
NO_OUTCOME = "No outcome available"
#: Token that ends the thinking part in lists of token ids.
THINK_TOKEN = 151668


@F.pandas_udf(StringType())
def _as_plain_json(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: loosejson.plain(t) or "", na_action="ignore")


# Keeps the optimizer from repeating the reader in filters it pushes down.
_as_plain_json = _as_plain_json.asNondeterministic()


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def plain_json(text: Column) -> Column:
    """A whole JSON text in plain notation; null where even the loose notations fail.

    Plain objects and arrays stay in the JVM as they are. Only the other texts
    go through the Python reader, which sees null in place of the plain ones.
    """
    # the strict parser stops after the first value, so more values show only within brackets
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).cast("array<variant>")
    plain = F.coalesce(text.rlike(r"^\s*[{\[]") & (F.size(parsed) == 1), F.lit(False))
    return F.nullif(F.coalesce(_as_plain_json(F.when(~plain, text)), text), F.lit(""))


def tolerant_json(df: DataFrame, column: str, schema: str, into: str) -> DataFrame:
    """Adds ``into``, the parsed ``column``; null where even the loose notations fail."""
    return df.withColumn(into, F.from_json(plain_json(F.col(column)), schema))


def _by_market(parts: Column, leaves: tuple[str, ...], scalar: str | None = None) -> Column:
    """Market -> struct of the leaves as text, from plain JSON: an array of objects with a ``market`` field, or an object by market.

    A value of the object that is no object stands for the leaf ``scalar``.
    Null for other values and where an element names no market.
    """
    inner = "struct<" + ", ".join(f"{x}: string" for x in leaves) + ">"

    def of_array(listed: Column) -> Column:
        entries = F.transform(listed, lambda e: F.struct(e["market"], F.struct(*(e[x].alias(x) for x in leaves))))
        return F.when(F.forall(listed, lambda e: e["market"].isNotNull()), F.map_from_entries(entries))

    def value(_: Column, v: Column) -> Column:
        whole = F.when(v.startswith("{"), F.from_json(v, inner))
        return whole if scalar is None else F.coalesce(whole, F.struct(*((v if x == scalar else F.lit(None).cast("string")).alias(x) for x in leaves)))

    listed = F.from_json(parts, f"array<struct<market: string, {inner[7:-1]}>>")
    of_object = F.transform_values(F.from_json(parts, "map<string, string>"), value)
    return F.when(parts.rlike(r"^\s*\["), _let(listed, of_array)).when(parts.rlike(r"^\s*\{"), of_object)


def read_prediction(prediction: Column) -> Column:
    """``(rationale, probabilities)`` of a prediction JSON in any notation, both as text, taken out of an outer ``prediction``."""
    def inner(parsed: Column) -> Column:
        return F.when(parsed["prediction"].rlike(r"^[{\[]"), F.from_json(parsed["prediction"], "map<string, string>")).otherwise(parsed)

    parsed = F.from_json(plain_json(prediction), "map<string, string>")
    return _let(_let(parsed, inner), lambda p: F.struct(p["rationale"].alias("rationale"), p["probabilities"].alias("probabilities")))


def read_probabilities(probabilities: Column) -> Column:
    """Market -> probability of the probabilities of ``read_prediction``, given as array or object; the last of repeated markets counts."""
    return F.transform_values(_by_market(probabilities, ("probability",), "probability"), lambda _, v: v["probability"].try_cast("double"))


def read_prices(market_data: Column) -> Column:
    """Market -> prices and liquidity of a market JSON in any notation, given as array or object."""
    by_market = _let(plain_json(market_data), lambda t: _by_market(t, PRICE_FIELDS))
    return F.transform_values(by_market, lambda _, v: F.struct(*(v[x].try_cast("double").alias(x) for x in PRICE_FIELDS)))


def read_outcome(outcome: Column) -> Column:
    """Market -> outcome of an outcome JSON in any notation."""
    return F.transform_values(F.from_json(plain_json(outcome), "map<string, string>"), lambda _, v: v.try_cast("double"))


def read_sources(sources: Column) -> Column:
    """Title, summary and url of each source of a sources JSON in any notation, taken out of an outer ``sources``; empty where unreadable."""
    listed = "array<struct<source_id: string, title: string, summary: string, url: string>>"

    def inner(plain: Column) -> Column:
        return F.coalesce(F.when(plain.rlike(r"^\s*\["), F.from_json(plain, listed)), F.from_json(plain, f"struct<sources: {listed}>")["sources"], F.array().cast(listed))

    return _let(plain_json(sources), inner)


def market_list_text(markets: Column) -> Column:
    """'A, B' from a JSON list of names or the names of a JSON object; else the text for no outcome."""
    listed = F.array_join(F.from_json(markets, "array<string>"), ", ")
    named = F.array_join(F.map_keys(F.from_json(markets, "map<string,string>")), ", ")
    return F.when(F.trim(markets).startswith("["), F.coalesce(listed, F.lit(NO_OUTCOME))).otherwise(F.coalesce(named, F.lit(NO_OUTCOME)))


def told(prediction: Column) -> tuple[Column, Column]:
    """Rationale and probabilities of a prediction JSON in any notation as text, '' where missing."""
    parsed = read_prediction(prediction)
    return F.coalesce(parsed["rationale"], F.lit("")), F.coalesce(parsed["probabilities"], F.lit(""))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def event_text(title: Column, outcome: Column) -> Column:
    return F.concat(F.lit("Event: "), title, F.lit("\nOutcomes: "), market_list_text(outcome))


def month_day(time: Column) -> Column:
    """'mm_dd' of 'Y-m-d H'; null if there is no date."""
    return F.date_format(F.try_to_timestamp(F.substring(time, 1, 10), F.lit("yyyy-MM-dd")), "MM_dd")


def prompt_hash(system: Column, user: Column) -> Column:
    return F.substring(F.md5(F.concat(system, user)), 1, 8)


def clean_title(answer: Column) -> Column:
    """A title without outer quotes and event tags."""
    return F.regexp_replace(F.regexp_replace(F.trim(answer), r"^\s*<event>\s*|\s*</event>\s*$", ""), r"^[\"']+|[\"']+$", "")


def without_assistant(messages: Column) -> Column:
    """The first two messages of a chat of two or three; null for other lengths and orders."""
    roles = F.transform(messages, lambda m: m["role"])
    fits = roles.isin(F.array(F.lit("system"), F.lit("user")), F.array(F.lit("system"), F.lit("user"), F.lit("assistant")))
    return F.when(fits, F.slice(messages, 1, 2))


def split_thinking(text: Column) -> tuple[Column, Column]:
    """(thinking, content) around the closing think tag; without one all is content."""
    end = F.locate("</think>", text)
    thinking = strip(F.regexp_replace(F.substring(text, F.lit(1), end - 1), r"^\s*<think>", ""))
    return F.when(end > 0, thinking), F.when(end > 0, strip(F.substring(text, end + len("</think>"), F.length(text)))).otherwise(strip(text))


def split_thinking_ids(ids: Column, token: int = THINK_TOKEN) -> tuple[Column, Column]:
    """(thinking, content) token ids around the last think token; without one all is content."""
    back = F.array_position(F.reverse(ids), token)
    cut_at = F.when(back > 0, F.size(ids) - back + 1).otherwise(0).cast("int")
    return F.slice(ids, F.lit(1), cut_at), F.slice(ids, cut_at + 1, F.greatest(F.size(ids) - cut_at, F.lit(0)))


def tagged_probabilities(content: Column) -> Column:
    """The JSON text of a probability block: between the tags on one line, else before the end tag, else all."""
    inline = F.regexp_extract(content, r"<probabilities>(.*)</probabilities>", 1)
    before = F.regexp_replace(F.substring_index(content, "</probabilities>", 1), r"(?s)^.*<probabilities>", "")
    return strip(F.when(F.length(inline) > 0, inline).when(content.contains("</probabilities>"), before).otherwise(content))


def strict_probabilities(content: Column) -> Column:
    """The JSON text after the start tag up to the end tag or the end; null without a start tag."""
    found = F.regexp_extract(content, r"(?s)<probabilities>(.*?)(</probabilities>|$)", 1)
    return F.when(content.contains("<probabilities>"), strip(found))


def probabilities_of(block: Column) -> Column:
    """Market -> probability of a JSON text in plain notation, an object or an array, taken out of an outer ``probabilities``.

    Null if there is none, or if any of them is no number.
    """
    def inner(parsed: Column) -> Column:
        outer = parsed["probabilities"]
        return F.when(outer.rlike(r"^[{\[]"), outer).otherwise(block)

    inside = _let(F.from_json(block, "map<string, string>"), inner)
    return _let(read_probabilities(inside), lambda m: F.when((F.size(m) > 0) & F.forall(F.map_values(m), lambda v: v.isNotNull()), m))


def mentions_leakage(rationale: Column) -> Column:
    """True if a field of the rationale holds the word, in lower case."""
    return F.coalesce(F.to_json(rationale).contains("leakage"), F.lit(False))


def replace_giveaways(rationale: Column, word: str = REPLACEMENT) -> Column:
    """Replaces the phrases in every field, in their order and as written."""
    def cleaned(text: Column) -> Column:
        for phrase in GIVEAWAYS:
            text = F.replace(text, F.lit(phrase), F.lit(word))
        return text

    return F.when(rationale.isNotNull(), F.struct(*(cleaned(rationale[f]).alias(f) for f in RATIONALE_FIELDS)))


def clean_rationales(df: DataFrame, column: str = "augmented_rationale") -> DataFrame:
    """Rows with a rationale that does not mention leakage, without giveaway phrases."""
    kept = df.filter(F.col(column).isNotNull() & ~mentions_leakage(F.col(column)))
    return kept.withColumn(column, replace_giveaways(F.col(column)))


def sources_text(sources: Column) -> Column:
    """Numbered sources with title and summary."""
    lines = F.transform(sources, lambda s, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), F.coalesce(s["title"], F.lit("")), F.lit(": "), F.coalesce(s["summary"], F.lit(""))))
    return F.array_join(lines, "\n")


def user_prompt(title: Column, outcomes: Column, sources: Column, market_data: Column) -> Column:
    """The user's part of a prediction prompt; market data only where there is any."""
    market = F.when(F.coalesce(F.length(market_data), F.lit(0)) > 2, F.concat(F.lit("\n\nMarket prices:\n"), market_data)).otherwise("")
    return F.concat(F.lit("Event: "), title, F.lit("\nPossible outcomes: "), outcomes, F.lit("\n\nSources:\n"), sources, market, F.lit("\n\nGive your reasoning, then your probabilities."))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat(system: Column, user: Column, assistant: Column | None = None) -> Column:
    """Messages as an array of (role, content)."""
    turns = [message("system", system), message("user", user)]
    return F.array(*turns, *([message("assistant", assistant)] if assistant is not None else []))


def assistant_text(rationale: Column, probabilities: Column) -> Column:
    """Analysis, rationale and probability block; null if a part of the rationale is missing."""
    parts = F.concat_ws("\n\n", *(rationale[f] for f in RATIONALE_FIELDS))
    whole = rationale["source_analysis"].isNotNull() & rationale["market_analysis"].isNotNull() & rationale["rationale"].isNotNull() & probabilities.isNotNull()
    return F.when(whole, F.concat(F.lit("<think>\n"), parts, F.lit("\n</think>\n<probabilities>\n"), probabilities, F.lit("\n</probabilities>")))

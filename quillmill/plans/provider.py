"""The pluggable provider of judgements: rules by default, recorded replies, a cache.

A provider is a function from a prompt to a reply. It runs on the executors, partition by
partition; distinct prompts are asked once and joined back, so the calls follow the
number of different prompts, not of rows. Nothing here opens a connection.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.session import cut_lineage


class Provider(Protocol):
    def reply(self, prompt: str) -> str | None: ...


def prompt_key(prompt: str) -> str:
    return hashlib.sha256(prompt.encode()).hexdigest()


@dataclass
class RecordedProvider:
    """Replies by the hash of the prompt; what was not recorded has none."""

    replies: dict[str, str]

    def reply(self, prompt: str) -> str | None:
        return self.replies.get(prompt_key(prompt))


@dataclass
class RuleProvider:
    """A function in the place of a model."""

    rule: Callable[[str], str | None]

    def reply(self, prompt: str) -> str | None:
        return self.rule(prompt)


@dataclass
class CachedProvider:
    inner: Provider
    calls: int = 0
    seen: dict[str, str | None] = field(default_factory=dict)

    def reply(self, prompt: str) -> str | None:
        key = prompt_key(prompt)
        if key not in self.seen:
            self.calls += 1
            self.seen[key] = self.inner.reply(prompt)
        return self.seen[key]


@dataclass
class RetryingProvider:
    """Asks again after an error, at most `tries` times; then there is no reply."""

    inner: Provider
    tries: int = 3

    def reply(self, prompt: str) -> str | None:
        for attempt in range(self.tries):
            try:
                return self.inner.reply(prompt)
            except Exception:  # noqa: BLE001  a provider may fail in any way
                if attempt + 1 == self.tries:
                    return None
        return None


def ask(df: DataFrame, prompt: str, provider: Provider, out: str = "reply") -> DataFrame:
    """df with the reply to each row's prompt; null prompts have none."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        retrying = RetryingProvider(provider)
        for batch in batches:
            prompts = batch.column(0)
            replies = pa.array([retrying.reply(p) for p in prompts.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([prompts, replies], names=["_prompt", out])

    asked = df.select(F.col(prompt).alias("_prompt")).filter("_prompt is not null").distinct().mapInArrow(answer, f"_prompt string, `{out}` string")
    return df.join(cut_lineage(asked), F.col(prompt) == F.col("_prompt"), "left").drop("_prompt")


@dataclass
class HttpProvider:
    """Asks a JSON service: `body` makes the request of a prompt, `read` takes the reply out of the answer.

    Nothing is connected before reply() is called. Errors are left to RetryingProvider.
    """

    url: str
    body: Callable[[str], dict]
    read: Callable[[dict], str | None]
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 60.0

    def reply(self, prompt: str) -> str | None:
        import urllib.request

        request = urllib.request.Request(self.url, json.dumps(self.body(prompt)).encode(), {"Content-Type": "application/json", **self.headers})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return self.read(json.load(answer))


@dataclass
class StructuredProvider:
    """Replies that are objects with these fields, as JSON: asked again until one is, at most `tries` times; then there is none."""

    inner: Provider
    fields: tuple[str, ...]
    tries: int = 3

    def reply(self, prompt: str) -> str | None:
        for _ in range(self.tries):
            found = repair_json(self.inner.reply(prompt) or "")
            if isinstance(found, dict) and all(f in found for f in self.fields):
                return json.dumps({f: found[f] for f in self.fields}, ensure_ascii=False)
        return None


#: Texts that stand for no value in a reply.
NO_VALUE = ("null", "None", "N/A")


def reply_items(js: Column, fields: tuple[str, ...]) -> Column:
    """array of maps: the objects of a reply's JSON array with these fields as trimmed text; unknown fields go, what says
    no value (zero and false too) is empty, and what is no object is left out. Null if nothing is left: an error of the reply."""

    def item(text: Column) -> Column:
        read = F.from_json(text, "map<string,string>")
        value = lambda f: F.trim(F.coalesce(F.try_element_at(read, F.lit(f)), F.lit("")))
        return F.create_map(*[x for f in fields for x in (F.lit(f), F.when(value(f).isin(*NO_VALUE, "false", "0"), "").otherwise(value(f)))])

    kept = F.filter(F.from_json(js, "array<string>"), lambda t: F.ltrim(t).startswith("{"))
    return F.when(F.size(kept) > 0, F.transform(kept, item))


def render(template: str, **values: object) -> str:
    """The template with its {names} filled in; names without a value stay as they are."""
    return re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), template)


def repair_json(text: str) -> object | None:
    """What a reply holds as JSON: fences and trailing commas are dropped; of a cut array, the complete objects stay."""
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", text.strip())
    begin = min((i for i in (body.find("{"), body.find("[")) if i >= 0), default=-1)
    if begin < 0:
        return None
    body = body[begin:]
    for candidate in (body, body[: max(body.rfind("}"), body.rfind("]")) + 1]):
        try:
            return json.loads(re.sub(r",\s*([}\]])", r"\1", candidate))
        except ValueError:
            continue
    found, decoder, at = [], json.JSONDecoder(), body.find("{")
    while body.startswith("[") and at >= 0:
        try:
            item, end = decoder.raw_decode(body, at)
        except ValueError:
            break
        found.append(item)
        at = body.find("{", end)
    return found or None


#: Words of a header and the target field they speak for, in the order they are tried.
FIELD_WORDS = (
    ("unit_price", ("unit price", "retailprice", "rate")), ("amount", ("extendedprice", "amount", "total price", "totalprice")),
    ("discount_rebate", ("discount", "rebate")), ("gst", ("gst", "tax")), ("quantity", ("quantity", "qty", "hours")),
    ("invoice_date", ("shipdate", "orderdate", "invoice date", "date")), ("item_description", ("item", "name", "description", "type")),
    ("uom", ("uom", "unit", "size")), ("invoice_number", ("orderkey", "invoice no", "invoice number")),
)


def propose_mappings(headers: DataFrame, table: str, header: str) -> DataFrame:
    """table, header, target, confidence, hint: one proposal a header by the words of FIELD_WORDS, through the provider."""

    def rule(prompt: str) -> str | None:
        low = re.sub(r"^[a-z]_", "", prompt.lower())
        for target, words in FIELD_WORDS:
            for word in words:
                if word in low:
                    hint = "date" if "date" in target else "currency" if target in ("unit_price", "amount", "gst") else "none"
                    return json.dumps({"target": target, "confidence": round(len(word) / max(len(low), 1), 2), "hint": hint})
        return None

    asked = ask(headers, header, RuleProvider(rule))
    reply = F.from_json("reply", "target string, confidence double, hint string")
    return asked.select(table, header, F.coalesce(reply["target"], F.lit("UNMAPPED")).alias("target"), F.coalesce(reply["confidence"], F.lit(0.0)).alias("confidence"), reply["hint"].alias("hint"))

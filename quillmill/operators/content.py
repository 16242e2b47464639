"""Recursive content: normalising, sibling levels, merging of batches.

A section's blocks are one nested JSON array. These steps rewrite the nesting itself, so
they are plain functions on it, applied section by section; everything relational
works on the flattened blocks of operators.tree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVEL = re.compile(r"^\s*(\d+(?:\.\d+)*)[.)]?(?:\s|$)")


def numbering_depth(heading: str | None) -> int:
    """Segments of a dotted number; 1 for `(x)`; 0 without a number."""
    found = _LEVEL.match(heading or "")
    if found:
        return len(found[1].split("."))
    return 1 if re.match(r"^\s*\([a-z0-9]+\)", heading or "", re.IGNORECASE) else 0


def normalise(block: object) -> list[dict]:
    """A block, whatever its age, as blocks of today: bare text is a paragraph; text, body, subsections and tables become content."""
    if block is None:
        return []
    if isinstance(block, list):
        return [b for x in block for b in normalise(x)]
    if not isinstance(block, dict):
        text = str(block)
        return [{"type": "paragraph", "text": text}] if text.strip() else []
    kind = block.get("type")
    if kind == "table":
        return [{"type": "table", "caption": block.get("caption") or "", "headers": block.get("headers") or [], "rows": block.get("rows") or []}]
    nested = any(k in block for k in ("content", "body", "subsections", "tables", "heading"))
    if kind == "paragraph" or (not nested and "text" in block):
        text = block.get("text") or ""
        return [{"type": "paragraph", "text": text}] if text.strip() else []
    content = normalise(block.get("text"))
    for key in ("content", "body"):
        content += normalise(block.get(key))
    content += [b for s in block.get("subsections") or [] for b in normalise({**s, "type": "subsection"} if isinstance(s, dict) else s)]
    content += [b for t in block.get("tables") or [] for b in normalise({**t, "type": "table"} if isinstance(t, dict) else t)]
    if kind == "subsection" or block.get("heading"):
        return [{"type": "subsection", "heading": block.get("heading") or "", "heading_level": block.get("heading_level") or "", "content": content}]
    return content


def _same_level(parent: dict, child: dict) -> bool:
    a, b = parent.get("heading_level"), child.get("heading_level")
    x, y = numbering_depth(parent.get("heading")), numbering_depth(child.get("heading"))
    return bool(a and a == b) or bool(x and x == y)


def level_siblings(blocks: list[dict]) -> list[dict]:
    """If a subsection holds one of its own level (with a heading), all subsections it holds follow it instead.

    A block is judged as it stands, before what it holds is levelled in turn.
    """
    out: list[dict] = []
    for block in blocks:
        inner = (block.get("content") or []) if block.get("type") == "subsection" else []
        children = [c for c in inner if c.get("type") == "subsection"]
        if any((c.get("heading") or "").strip() and _same_level(block, c) for c in children):
            out += [{**block, "content": [c for c in inner if c.get("type") != "subsection"]}, *level_siblings(children)]
        else:
            out.append({**block, "content": level_siblings(inner)} if inner else block)
    return out


def merge_batches(batches: list[list[dict]]) -> list[dict]:
    """One list out of the batches of a section: what leads a batch goes into the last
    subsection so far; a subsection with the same or no heading continues it; from
    another subsection on, everything is at the top."""
    merged: list[dict] = []
    for batch in batches:
        open_ = bool(merged) and merged[-1].get("type") == "subsection"
        for block in batch:
            last = merged[-1] if merged else None
            if open_ and block.get("type") != "subsection":
                last["content"] = [*last["content"], block]
            elif open_ and (block.get("heading") or "").strip() in ("", (last.get("heading") or "").strip()):
                last["content"] = [*last["content"], *(block.get("content") or [])]
            else:
                merged.append(dict(block))
                open_ = False
    return merged


def drop_repeats(blocks: list[dict]) -> list[dict]:
    """Of equal paragraphs of one list the first stays; subsections by themselves."""
    seen, out = set(), []
    for b in blocks:
        if b.get("type") == "paragraph":
            if b.get("text") in seen:
                continue
            seen.add(b.get("text"))
        elif b.get("type") == "subsection":
            b = {**b, "content": drop_repeats(b.get("content") or [])}
        out.append(b)
    return out


def prune(value: object, typed: bool = True) -> object:
    """Objects without content become {}, lists lose what is empty; other fields stay.

    typed: blocks that have a `type` stay as they are, and numbers alone are no content;
    without it numbers are content and types do not count (the older format).
    """
    if isinstance(value, list):
        kept = (prune(v, typed) for v in value)
        return [v for v in kept if v or (typed and isinstance(v, dict) and "type" in v)]
    if not isinstance(value, dict):
        return value
    out = {k: prune(v, typed) for k, v in value.items()}
    if typed and "type" in out:
        return out
    counts = (str, list, dict) if typed else object
    return out if any(v for v in out.values() if isinstance(v, counts)) else {}


def leaf_texts(value: object, skipped: tuple[str, ...] = ("image",)) -> list[str]:
    """All texts of a nested value, in order, trimmed; keys that begin with `_` or are skipped are left out."""
    if isinstance(value, str):
        return [value.strip()] if value.strip() else []
    if isinstance(value, dict):
        return [t for k, v in value.items() if not k.startswith("_") and k not in skipped for t in leaf_texts(v, skipped)]
    return [t for v in value for t in leaf_texts(v, skipped)] if isinstance(value, list) else []


#: Structural words that are no text of a clause.
LABELS = ("paragraph", "subsection", "section_start", "table", "heading", "list_item", "bullet")


def clause_texts(value: object) -> list[str]:
    """Texts of a clause: an object with a text says only that; structural words and bare numbers of one or two digits are left out."""
    if isinstance(value, str):
        bare = value.strip()
        return [] if not value or bare in LABELS or (bare.isdigit() and len(bare) <= 2) else [value]
    if isinstance(value, dict):
        own = value.get("text")
        if isinstance(own, str) and own.strip():
            return [own.strip()]
        return [t for v in value.values() for t in clause_texts(v)]
    return [t for v in value for t in clause_texts(v)] if isinstance(value, list) else []


def _trimmed(value: object) -> list[str]:
    return [value.strip()] if isinstance(value, str) and value.strip() else []


def _lines(block: object) -> list[str]:
    """The lines a block of any age is read as."""
    if not isinstance(block, dict):
        return _trimmed(block)
    kind, heading, text = block.get("type"), _trimmed(block.get("heading")), _trimmed(block.get("text"))
    if kind == "paragraph":
        return text
    if kind == "table":
        listed = [block.get("headers") or [], *(r for r in block.get("rows") or [] if isinstance(r, list))]
        return _trimmed(block.get("caption")) + [" | ".join("" if c is None else str(c) for c in row) for i, row in enumerate(listed) if i or row]
    inside = [line for b in _listed(block.get("content")) for line in _lines(b)]
    if kind == "subsection":
        return heading + inside
    return text + [h for h in heading if h not in text] + inside


def _listed(value: object) -> list:
    return value if isinstance(value, list) else []


def section_lines(data: object) -> list[str]:
    """A section's text for review: heading, content, then the fields older documents have (body, subsections, tables, text)."""
    if not isinstance(data, dict):
        return [line for b in _listed(data) for line in _lines(b)]
    heading = _trimmed(data.get("heading"))
    out = heading + [line for b in _listed(data.get("content")) for line in _lines(b)]
    out += [line for b in _listed(data.get("body")) for line in _trimmed(b)]
    for part in _listed(data.get("subsections")):
        if isinstance(part, dict):
            out += _trimmed(part.get("heading")) + [line for b in _listed(part.get("body", part.get("content"))) for line in _lines(b)]
    for table in _listed(data.get("tables")):
        if isinstance(table, dict):
            out += _lines({**table, "type": "table"})
    return out + [t for t in _trimmed(data.get("text")) if t not in heading]


def mostly_empty(data: dict) -> bool:
    """True if more than half of an object's values are blank, empty, or objects of which the same is true; also for {}."""
    blank = [v is None or (isinstance(v, str) and not v.strip()) or v == [] or (isinstance(v, dict) and mostly_empty(v)) for v in data.values()]
    return 2 * sum(blank) > len(blank) or not blank


def field_counts(value: object) -> tuple[int, int]:
    """How many leaves a nested value has, and how many of them are blank or empty."""
    parts = list(value.values()) if isinstance(value, dict) else value if isinstance(value, list) else None
    if parts:
        counted = [field_counts(p) for p in parts]
        return sum(n for n, _ in counted), sum(e for _, e in counted)
    return 1, int(value is None or parts is not None or (isinstance(value, str) and not value.strip()))


#: Bytes of JSON whose results a worker holds before it hands them on.
CHUNK = 1 << 20


def json_column(js: Column, f: Callable[[object], object], kind: str) -> Column:
    """f of the parsed JSON of each row, chunk by chunk; null for null and malformed JSON."""

    @F.arrow_udf(kind)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in _chunks(batch):
                yield pa.array([_applied(f, text) for text in texts], from_ddl(kind))

    return read(js)


def _chunks(batch: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch in order, about CHUNK bytes at a time; a longer one by itself or last."""
    begin = held = 0
    for end, n in enumerate(pa.compute.binary_length(batch).fill_null(0).to_pylist(), 1):
        held += n
        if held >= CHUNK or end == len(batch):
            yield batch[begin:end].to_pylist()
            begin, held = end, 0


def _applied(f: Callable[[object], object], text: str | None) -> object:
    try:
        value = json.loads(text) if text is not None else None
    except ValueError:
        return None
    return None if text is None else f(value)


_COUNTS = "struct<total:long,empty:long>"
_ARROW = {"string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), _COUNTS: pa.struct([("total", pa.int64()), ("empty", pa.int64())])}


def from_ddl(kind: str) -> pa.DataType:
    """The Arrow type of the few kinds that json_column() returns."""
    return _ARROW[kind] if kind in _ARROW else pa.struct([(n, _ARROW[READERS[n][1]]) for n in re.findall(r"`(\w+)`:", kind)])


#: What is read out of a section's JSON, by name: the function, and its type.
READERS: dict[str, tuple[Callable[[object], object], str]] = {
    "all_text": (lambda v: " ".join(leaf_texts(v)), "string"),
    "plain_text": (lambda v: " ".join(leaf_texts(v, ("image", "type"))), "string"),
    "clause_text": (lambda v: "\n".join(clause_texts(v)), "string"),
    "section_text": (lambda v: "\n".join(section_lines(v)), "string"),
    "pruned": (lambda v: json.dumps(prune(v), ensure_ascii=False), "string"),
    "pruned_old": (lambda v: json.dumps(prune(v, typed=False), ensure_ascii=False), "string"),
    "mostly_empty": (lambda v: mostly_empty(v) if isinstance(v, dict) else None, "boolean"),
    "field_counts": (lambda v: dict(zip(("total", "empty"), field_counts(v), strict=True)), _COUNTS),
}


def read_json(js: Column, reader: str) -> Column:
    return json_column(js, *READERS[reader])


def read_json_struct(js: Column, readers: tuple[str, ...]) -> Column:
    """A struct of what several readers find, null for null and malformed JSON.

    Each JSON is parsed once, in one Python worker: functions of their own would take a worker each in every task.
    """
    read = {n: READERS[n][0] for n in readers}
    kind = ",".join(f"`{n}`:{READERS[n][1]}" for n in readers)
    return json_column(js, lambda v: {n: f(v) for n, f in read.items()}, f"struct<{kind}>")


def merge_sections(df: DataFrame, keys: list[str], batch: str, content: str) -> DataFrame:
    """keys, content: the merged JSON of each section's batches, in order. A section's batches are a few pages each."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [normalise(json.loads(c)) for c in rows.sort_values(batch)[content] if c]
        merged = drop_repeats(level_siblings(merge_batches(parts)))
        return pd.DataFrame({**{k: [rows[k].iloc[0]] for k in keys}, content: [json.dumps(merged, ensure_ascii=False)]})

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.groupBy(*keys).applyInPandas(merge, f"{kinds}, `{content}` string")

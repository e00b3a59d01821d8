"""Chat formatting by schema fingerprint, with DataFrame functions only.

A record is a VARIANT of any layout: message lists, prompt and response, instruction and input, nested or
with content parts. Its fingerprint is a hash of its nested field paths (value types do not count). The
fingerprint selects a declarative ``Layout``, which says where the turns are; the turns become canonical
``array<struct<role, text>>``. A template turns them into one string with marks around each turn, and the
loss mask lists the spans of the assistant's texts as code point offsets into that string.

Marks inside roles and texts are escaped with a backslash, which is doubled itself, so ``parse`` gives back
exactly the turns that were formatted.

Defined results: null texts and roles are empty strings. A record whose fingerprint no layout declares has
null turns and null output (``layout`` is null too), so it can be counted; a record with an empty or null
list has no turns and an empty output. A conversation's output is one string, so the turns of a
conversation meet in one row by nature; nothing else is gathered. Turns of equal number are ordered by
role and text.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

TURNS = "array<struct<role string, text string>>"


@dataclass(frozen=True)
class Layout:
    """Paths are dotted; ``[]`` marks a list. Either ``each`` (a list's role and text paths, relative to the
    list ``turns``) or ``fixed`` (role, paths whose non-empty texts are joined by a blank line)."""

    name: str
    turns: str | None = None
    each: tuple[str, str] | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    #: Paths that may be missing or hold nothing to format.
    ignored: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.turns is not None:
            return [f"{self.turns}[].{p}" for p in self.each]
        return [p for _, paths in self.fixed for p in paths]

    def shapes(self) -> list[str]:
        free = [*self.optional, *self.ignored]
        always = [p for p in self.paths() if p not in free]
        kinds = [always]
        if self.turns is not None:  # an empty list and a null have no paths below
            kinds += [[f"{self.turns}[]"], [self.turns]]
        return [shape([*k, *extra]) for k in kinds for n in range(len(free) + 1) for extra in combinations(free, n)]


#: Layouts of public datasets, and role names that mean the same.
LAYOUTS = (
    Layout("messages", "messages", ("role", "content"), ignored=("id", "source")),
    Layout("message_parts", "messages", ("role", "content[].text"), ignored=("messages[].content[].type", "id")),
    Layout("turns", "turns", ("role", "text"), ignored=("id",)),
    Layout("from_value", "conversations", ("from", "value"), ignored=("id", "source")),
    Layout("nested_messages", "data.messages", ("role", "content"), ignored=("id", "data.id")),
    Layout("prompt_response", fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",), ignored=("id",)),
    Layout("prompt_completion", fixed=(("user", ("prompt",)), ("assistant", ("completion",))), ignored=("id",)),
    Layout("instruction", fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input"), ignored=("id",)),
    Layout("question_answer", fixed=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",), ignored=("id",)),
    Layout("one_text", fixed=(("assistant", ("text",)),), ignored=("id",)),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def shape(paths: list[str]) -> str:
    """The canonical text of a set of paths, as ``fingerprint`` sees a record that has them."""
    root: dict = {}
    for path in paths:
        at = root
        for part in path.replace("[]", ".[]").split("."):
            at = at.setdefault(part, {})

    def text(node: dict) -> str:
        if set(node) == {"[]"}:
            return f"ARRAY<{text(node['[]'])}>"
        if not node:
            return ""
        return "OBJECT<" + ", ".join(f"{k}: {t}" if (t := text(node[k])) else k for k in sorted(node)) + ">"

    return text(root)


_SCALAR = r"(?:STRING|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)|BOOLEAN|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VOID|VARIANT|UUID)"


def record_shape(record: Column) -> Column:
    no_types = F.regexp_replace(F.schema_of_variant(record), rf": {_SCALAR}(?=[,>])", "")
    return F.regexp_replace(no_types, rf"<{_SCALAR}>", "<>")


def fingerprint(record: Column) -> Column:
    return F.xxhash64(record_shape(record))


def _role(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(c)), c, F.lit(""))


def _value(v: Column, path: str) -> Column:
    """Text at a dotted path below a VARIANT; a path with ``[]`` joins the list's texts."""
    if "[]" in path:
        head, tail = path.split("[].", 1)
        parts = F.transform(F.try_variant_get(v, f"$.{head}", "array<variant>"), lambda x: _value(x, tail))
        return F.coalesce(F.array_join(parts, ""), F.lit(""))
    return F.coalesce(F.try_variant_get(v, f"$.{path}", "string"), F.lit(""))


def _turns(record: Column, layout: Layout) -> Column:
    make = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    if layout.turns is not None:
        role, text = layout.each
        items = F.try_variant_get(record, f"$.{layout.turns}", "array<variant>")
        return F.coalesce(F.transform(items, lambda x: make(_role(_value(x, role)), _value(x, text))), F.array().cast(TURNS))
    turns = []
    for role, paths in layout.fixed:
        texts = F.array(*[_value(record, p) for p in paths])
        joined = F.array_join(F.filter(texts, lambda x: x != ""), "\n\n") if len(paths) > 1 else texts[0]
        turn = make(F.lit(role), joined)
        turns.append(F.when(_value(record, paths[0]) != "", turn) if set(paths) <= set(layout.optional) else turn)
    return F.filter(F.array(*turns), lambda x: x.isNotNull())


def canonical(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """``struct<layout string, turns>`` of a VARIANT record, by its fingerprint."""
    out = F.lit(None).cast(f"struct<layout string, turns {TURNS}>")
    seen = fingerprint(record)
    for layout in reversed(layouts):
        mine = F.struct(F.lit(layout.name).alias("layout"), _turns(record, layout).cast(TURNS).alias("turns"))
        out = F.when(seen.isin([F.xxhash64(F.lit(s)) for s in layout.shapes()]), mine).otherwise(out)
    return out


#: Fixed values of the template: what opens a turn, follows its role, ends it; and the escapes.
OPEN, AFTER, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = ((":", "\\c"),)


def _replace(c: Column, pairs) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(c: Column) -> Column:
    return _replace(c, ESCAPES)


def unescape(c: Column) -> Column:
    """Pairs of backslashes are taken from the left, so what lies between them holds marks only."""
    parts = F.split(c, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: _replace(p, [(b, a) for a, b in (*ESCAPES[1:], *ROLE_ESCAPES)])), "\\")


def formatted(turns: Column) -> Column:
    """``struct<formatted string, loss array<struct<start, length>>>``; null for null turns."""
    pieces = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(OPEN), _replace(escape(F.coalesce(t["role"], F.lit(""))), ROLE_ESCAPES), F.lit(AFTER)).alias("head"),
        escape(F.coalesce(t["text"], F.lit(""))).alias("body"), (t["role"] == "assistant").alias("learn")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start long, length long>>").alias("loss"))

    def add(state: Column, p: Column) -> Column:
        start, size = state["at"] + F.length(p["head"]), F.length(p["body"]).cast("long")
        mine = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size + len(END)).alias("at"), F.when(p["learn"], F.concat(state["loss"], mine)).otherwise(state["loss"]).alias("loss"))

    text = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return F.when(turns.isNotNull(), F.struct(text.alias("formatted"), F.aggregate(pieces, zero, add)["loss"].alias("loss")))


def parse(text: Column) -> Column:
    """The turns that a formatted string holds."""
    cut = F.split(text, END)
    turn = rf"(?s)^{OPEN}(.*?){AFTER}(.*)$"
    return F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), lambda s: F.struct(
        unescape(F.regexp_extract(s, turn, 1)).alias("role"), unescape(F.regexp_extract(s, turn, 2)).alias("text")))


def masked(text: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def records_of_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, record)`` from one row per turn: a VARIANT of the ``turns`` layout."""
    c = lambda n: F.col(f"`{n}`")
    turns = df.groupBy(c(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(F.struct(
        c(turn).alias("turn"), c(role).cast("string").alias("role"), c(text).cast("string").alias("text")))).alias("t"))
    record = F.to_variant_object(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))
    return turns.select("conv_id", record.alias("record"))


def chat(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout, formatted, loss`` instead of the record; these three must be new names."""
    rest = [F.col(f"`{x}`") for x in records.columns if x != record]
    clash = {"layout", "formatted", "loss"} & {x.lower() for x in records.columns if x != record}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    mid, out = fresh(records, "canonical"), fresh(records, "out")
    turned = records.select(*rest, canonical(F.col(f"`{record}`"), layouts).alias(mid))
    return turned.select(*rest, F.col(f"{mid}.layout").alias("layout"), formatted(F.col(f"{mid}.turns")).alias(out)).select(
        *rest, "layout", f"{out}.formatted", f"{out}.loss")

"""Chat formatting by schema fingerprints, with built-in expressions only.

A record is a JSON object.  Its nested field paths that any mapping knows,
sorted and hashed, are its fingerprint; the fingerprint selects a declarative
mapping, which turns the record into canonical turns (role, text).  The turns
are then written by a template with control strings around each turn.

Escaping is reversible: a backslash is doubled and a backslash is put into
``<|``, so no text or role can hold a control string.

Defined cases: a record of no known layout has null turns (``format_turns``
drops none: its formatted text is null too); null roles and texts count as
empty; no turns give an empty text; repeated records are formatted each for
itself if their keys differ (the key must be unique); extra columns are left
out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
LISTS = ("messages", "conversations", "turns")


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths it is known by, and where its turns stand.  Either
    ``items`` names a list whose entries have ``role`` and ``text`` fields, or
    ``fields`` gives (path, role) for each turn; several paths of one turn are
    joined by a blank line."""

    name: str
    paths: tuple[str, ...]
    items: str | None = None
    role: str | None = None
    text: str | None = None
    rename: bool = False  # roles by ROLE_NAMES
    fields: tuple[tuple[tuple[str, ...], str], ...] = ()


MAPPINGS = (
    Mapping("messages", ("messages", "messages[].content", "messages[].role"), "messages", "role", "content"),
    Mapping("from_value", ("conversations", "conversations[].from", "conversations[].value"),
            "conversations", "from", "value", rename=True),
    Mapping("turns", ("turns", "turns[].speaker", "turns[].text"), "turns", "speaker", "text", rename=True),
    Mapping("prompt_response", ("prompt", "response"),
            fields=((("prompt",), "user"), (("response",), "assistant"))),
    Mapping("prompt_completion", ("completion", "prompt"),
            fields=((("prompt",), "user"), (("completion",), "assistant"))),
    Mapping("question_answer", ("answer", "question"),
            fields=((("question",), "user"), (("answer",), "assistant"))),
    Mapping("instruction", ("instruction", "output"),
            fields=((("instruction",), "user"), (("output",), "assistant"))),
    Mapping("instruction_input", ("input", "instruction", "output"),
            fields=((("instruction", "input"), "user"), (("output",), "assistant"))),
    Mapping("system_prompt_response", ("prompt", "response", "system"),
            fields=((("system",), "system"), (("prompt",), "user"), (("response",), "assistant"))),
)
# Other names of the roles
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def digest(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _inner(record: Column, name: str) -> Column:
    """The entries of a list field, each as JSON text (null: no such list)."""
    return F.from_json(F.get_json_object(record, f"$.{name}"), "array<string>")


def fingerprint(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Hash of the record's nested field paths, of those that a mapping names."""
    known = sorted({p for m in mappings for p in m.paths})

    def prefixed(name: str):
        return lambda k: F.concat(F.lit(f"{name}[]."), k)

    paths = [F.json_object_keys(record)]
    for name in LISTS:
        keys = F.flatten(F.transform(_inner(record, name), lambda e: F.coalesce(
            F.json_object_keys(e), F.array().cast("array<string>"))))
        paths.append(F.transform(keys, prefixed(name)))
    none = F.array().cast("array<string>")
    found = F.array_intersect(F.flatten(F.array(*[F.coalesce(p, none) for p in paths])),
                              F.array(*[F.lit(k) for k in known]))
    return F.sha2(F.array_join(F.array_sort(found), "\n"), 256)


def canonical_turns(record: Column, print_: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """``array<struct<role, text>>`` by the mapping that the fingerprint selects."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])

    def turn(m: Mapping):
        def role(e):
            return F.coalesce(F.try_element_at(names, e[m.role]), e[m.role]) if m.rename else e[m.role]

        return lambda e: F.struct(empty(role(e)).alias("role"), empty(e[m.text]).alias("text"))

    out = None
    for m in mappings:
        if m.items:
            entries = F.from_json(F.get_json_object(record, f"$.{m.items}"),
                                  f"array<struct<`{m.role}`:string,`{m.text}`:string>>")
            turns = F.transform(entries, turn(m))
        else:
            turns = F.array(*[F.struct(F.lit(role).alias("role"), F.array_join(F.array_compact(F.array(*[
                F.nullif(F.get_json_object(record, f"$.{p}"), F.lit("")) for p in paths])), "\n\n").alias("text"))
                for paths, role in m.fields])
        hit = print_ == F.lit(digest(m.paths))
        out = F.when(hit, turns) if out is None else out.when(hit, turns)
    return out


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column) -> Column:
    """A role stands on a line of its own, so its line ends are escaped too."""
    return F.replace(escape(c), F.lit("\n"), F.lit("<\\/"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("<\\/"), F.lit("\n")))


def format_records(df: DataFrame, key: str, record: str) -> DataFrame:
    """``key, layout`` (fingerprint), ``formatted`` and ``mask``: for each turn
    ``(start, length, loss)``, the place of its text in ``formatted`` in code
    points and whether it is trained on."""
    d = df.select(F.col(key).alias("_k"), F.col(record).alias("_r"))
    d = d.select("_k", "_r", fingerprint(F.col("_r")).alias("layout"))
    d = d.select("_k", "layout", canonical_turns(F.col("_r"), F.col("layout")).alias("_turns"))
    t = d.select("_k", "layout", F.posexplode_outer("_turns").alias("_i", "_t"))
    t = t.select("_k", "layout", "_i", F.col("_t.role").alias("_role"),
                 F.concat(F.lit(BEGIN), escape_role(F.col("_t.role")), F.lit("\n")).alias("_head"),
                 escape(F.col("_t.text")).alias("_body"))
    size = F.length("_head") + F.length("_body") + F.lit(len(END))
    w = Window.partitionBy("_k").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("_at", F.coalesce(F.sum(size.cast("long")).over(w), F.lit(0)))
    g = t.groupBy("_k").agg(
        F.first("layout").alias("layout"),
        F.sort_array(F.collect_list(F.when(F.col("_i").isNotNull(), F.struct(
            "_i", F.concat("_head", "_body", F.lit(END)).alias("s"),
            (F.col("_at") + F.length("_head")).alias("start"), F.length("_body").cast("long").alias("length"),
            (F.col("_role") == TRAINED_ROLE).alias("loss"))))).alias("_all"))
    return g.select(
        F.col("_k").alias(key), "layout", F.array_join(F.transform("_all", lambda x: x["s"]), "").alias("formatted"),
        F.transform("_all", lambda x: F.struct(x["start"], x["length"], x["loss"])).alias("mask"))


def read_back(df: DataFrame, key: str) -> DataFrame:
    """Turns read from ``formatted`` and ``mask``: ``key, turn, role, text,
    loss_text`` (null outside the mask), ``n_chars`` (of the written turn)."""
    # a piece for each turn, by the end marks; each is read with its own mask entry
    pieces = F.split("formatted", r"(?<=<\|im_end\|>\n)(?=<\|im_start\|>|\z)")
    pieces = F.filter(pieces, lambda x: x != "")
    d = df.select(F.col(key), F.posexplode(F.arrays_zip(pieces.alias("p"), F.col("mask").alias("m"))).alias("turn", "_x"))
    d = d.select(key, "turn", F.col("_x.p").alias("_p"), F.col("_x.m").alias("_m"))
    w = Window.partitionBy(key).orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_at", F.coalesce(F.sum(F.length("_p").cast("long")).over(w), F.lit(0)))
    line = F.locate("\n", F.col("_p"))
    inside = F.substr("_p", (F.col("_m.start") - F.col("_at") + 1).cast("int"), F.col("_m.length").cast("int"))
    return d.select(
        key, "turn",
        unescape_role(F.substr("_p", F.lit(len(BEGIN) + 1), line - len(BEGIN) - 1)).alias("role"),
        unescape(F.substr("_p", line + 1, F.length("_p") - line - len(END))).alias("text"),
        F.when(F.col("_m.loss"), unescape(inside)).alias("loss_text"), F.length("_p").cast("long").alias("n_chars"))

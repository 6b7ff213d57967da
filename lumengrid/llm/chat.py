"""Chat formatting by schema fingerprints.

A record's layout is known by a fingerprint: the hash of its nested field paths, lists written as []. A registry maps
fingerprints to declarative mappings (which field holds the turns, the role, the text), so that prompt/response,
instruction/input/output, message lists and single turn rows all become canonical turns. A layout with fields beyond a
mapping's takes the mapping that covers most of it; each fingerprint is resolved once. A field may hold a text, a list of
content parts (their texts are joined; others, such as images, aren't text) or one part; an assistant's tool calls follow
its text, each as a line of JSON; a `system` text and a `history` of earlier rounds go first. Whatever a record holds
beyond that is listed, path by path, in `dropped`. A template then marks turns and escapes control strings inside texts
reversibly; the loss mask covers the assistant texts.

Formatting works turn by turn: a conversation's output is the concatenation of its pieces in turn order, so a huge
conversation is never held whole. Only its digests need its pieces in one order; they stream through a sorted partition.

Defined cases: a null text or role is empty; a record gives at least one row: one without turns (an empty list) a row
with its layout and a null part, one of an unknown layout (null, no JSON object, none of the mappings' fields) also a
null layout, so that it can be counted; turns() takes only turns. Turns with equal numbers are ordered by role and text;
repeated rows are turns each; numbers and booleans count as their JSON text, and a container that is no content part is
never text; rows with a null conv_id form one conversation; a text of any length is formatted whole;
an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Layouts that a task remembers before it starts anew.
MOST_LAYOUTS = 10_000
#: Names of roles in other layouts: fixed values.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """turns: the list's field, or none if the record is flat; parts: (role field or fixed role, text fields) of each turn; before: the fields of what goes first, if a record has them."""

    name: str
    fields: tuple[str, ...]
    turns: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()
    before: tuple[str, ...] = ("system", "history")


#: Layouts: fixed values. A role that starts with @ names a field.
MAPPINGS = (
    Mapping("turn_row", ("conv_id", "turn", "role", "text"), "", (("@role", ("text",)),), ("conv_id", "turn", "role", "text"), ()),
    Mapping("messages", ("messages[].role", "messages[].content"), "messages", (("@role", ("content",)),)),
    Mapping("system_messages", ("system", "messages[].role", "messages[].content"), "messages", (("@role", ("content",)),)),
    Mapping("from_value", ("conversations[].from", "conversations[].value"), "conversations", (("@from", ("value",)),)),
    Mapping("prompt_response", ("prompt", "response"), "", (("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("prompt_completion", ("prompt", "completion"), "", (("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("instruction", ("instruction", "input", "output"), "", (("user", ("instruction", "input")), ("assistant", ("output",))), ("input",)),
    Mapping("question_answer", ("question", "answer"), "", (("user", ("question",)), ("assistant", ("answer",)))),
)
#: Fields of a tool call that its line of JSON tells, and others that only describe it: fixed values.
CALLS, CALL_FIELDS = "tool_calls", ("function.name", "function.arguments", "name", "arguments", "id", "type", "index")


def paths(value, prefix: str = "") -> set[str]:
    """The nested field paths of a decoded record."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths(v, prefix + "[]") for v in value)) if value else {prefix + "[]"}
    return {prefix}


def fingerprint(fields) -> str:
    return hashlib.sha1("\n".join(sorted(fields)).encode()).hexdigest()[:16]


def registry(mappings=MAPPINGS) -> dict[str, Mapping]:
    """Fingerprint to mapping, for each set of optional fields that may be missing."""
    return {fingerprint(set(m.fields) - set(gone)): m for m in reversed(mappings) for n in range(len(m.optional) + 1) for gone in combinations(m.optional, n)}


def _has(field: str, own: set[str]) -> bool:
    """Whether a layout has a field: as a value, or as content parts."""
    return field in own or any(p.startswith((f"{field}[]", f"{field}.")) for p in own)


def resolve(own: set[str], known: dict[str, Mapping], mappings=MAPPINGS) -> Mapping | None:
    """The mapping of a layout: that of its fingerprint, else the one that covers most of its fields among those whose required fields it has; the first at ties. Remembered under the fingerprint."""
    key = fingerprint(own)
    if key not in known:
        # an empty list has no fields below it
        there = lambda m, f: _has(f, own) or (m.turns and f.startswith(f"{m.turns}[].") and f"{m.turns}[]" in own)
        fits = [m for m in mappings if all(there(m, f) for f in set(m.fields) - set(m.optional)) and (f"{m.turns}[]" in own or any(_has(f, own) for f in m.fields))]
        known[key] = max(fits, key=lambda m: sum(_has(f, own) for f in m.fields), default=None)
    return known[key]


def said(value) -> str:
    """The text of a field: itself, or that of its content parts. Containers that are none have no text."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "".join(said(v) for v in value if not isinstance(v, list))
    if isinstance(value, dict):
        return value["text"] if isinstance(value.get("text"), str) and value.get("type", "text") in _TEXT_PARTS else ""
    return json.dumps(value)


#: Kinds of content parts that hold text: fixed values.
_TEXT_PARTS = ("text", "input_text", "output_text")


def called(item: dict) -> str:
    """The tool calls of a message, a line of JSON each."""
    calls = item.get(CALLS)
    out = []
    for call in calls if isinstance(calls, list) else []:
        if isinstance(call, dict):
            own = call["function"] if isinstance(call.get("function"), dict) else call
            out.append(json.dumps({k: own[k] for k in ("name", "arguments") if k in own}, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
    return "\n".join(out)


def _earlier(history) -> list[tuple[str, str]]:
    """Rounds before: pairs of a question and an answer, or messages."""
    out: list[tuple[str, str]] = []
    for item in history if isinstance(history, list) else []:
        if isinstance(item, list):
            out += [(("user", "assistant")[k % 2], said(x)) for k, x in enumerate(item)]
        elif isinstance(item, dict):
            role = said(item.get("role"))
            out.append((ROLES.get(role, role), said(item.get("content"))))
    return out


def _valued(value, prefix: str = "") -> set[str]:
    """The paths of a record that hold something."""
    if isinstance(value, dict):
        return set().union(*(_valued(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(_valued(v, prefix + "[]") for v in value))
    return set() if value is None or value == "" else {prefix}


def _dropped(record: dict, m: Mapping) -> list[str]:
    """Paths that hold something which no turn shows."""
    base = f"{m.turns}[]." if m.turns else ""
    texts = {base + f for _, fields in m.parts for f in fields} | {f for f in m.before if f == "system"} | ({"history[].content"} if "history" in m.before else set())
    plain = {base + r[1:] for r, _ in m.parts if r.startswith("@")} | {f for f in m.fields if f in ("conv_id", "turn")} | ({"history[][]", "history[].role"} if "history" in m.before else set())
    shown = texts | plain | {f"{t}{end}" for t in texts for end in ("[]", ".text", ".type", "[].text", "[].type")}
    out = []
    for p in _valued(record):
        call = p.startswith(f"{base}{CALLS}[].") and any(p[len(base) + len(CALLS) + 3 :] == f or p[len(base) + len(CALLS) + 3 :].startswith((f + ".", f + "[]")) for f in CALL_FIELDS)
        if p not in shown and not call:
            out.append(p)
    return sorted(out)


def mapped(record, known: dict[str, Mapping]) -> tuple[str | None, list[tuple[str, str]], list[str]]:
    """The layout's name, the turns (role, text), and the paths of what they don't show."""
    m = resolve(paths(record), known) if isinstance(record, dict) else None
    items = [] if m is None else record[m.turns] if m.turns else [record]
    if m is None or not isinstance(items, list) or not all(isinstance(i, dict) for i in items):
        return None, [], sorted(_valued(record)) if isinstance(record, dict) else []
    out = []
    if "system" in m.before and record.get("system") is not None:
        out.append(("system", said(record["system"])))
    if "history" in m.before:
        out += _earlier(record.get("history"))
    for item in items:
        for role, fields in m.parts:
            name = said(item.get(role[1:])) if role.startswith("@") else role
            name = ROLES.get(name, name)
            texts = [said(item.get(f)) for f in fields] + ([called(item)] if name == "assistant" else [])
            out.append((name, "\n".join(t for t in texts if t)))
    return m.name, out, _dropped(record, m)


def canonical(record, known: dict[str, Mapping]) -> tuple[str | None, list[tuple[str, str]]]:
    """The layout's name and the turns of a record."""
    return mapped(record, known)[:2]


def _decoded(text: str | None):
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


def escape(text: str) -> str:
    """No control string is left, and unescape() gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def piece(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its loss mask starts and ends (equal if it has none)."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE + "\n", len(head), len(head) + (len(body) if role == "assistant" else 0)


_PIECE = re.compile(re.escape(OPEN) + r"(.*?)\n(.*)" + re.escape(CLOSE) + "\n", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    found = re.findall(re.escape(OPEN) + r"(.*?)\n(.*?)" + re.escape(CLOSE) + "\n", formatted, re.S)
    return [(unescape(r), unescape(t)) for r, t in found]


def turns_of(records: DataFrame, conv: str, turn: str, record: str) -> DataFrame:
    """(conv_id, turn, part, layout, fingerprint, dropped, role, text) of JSON records: the record's number orders it, a list's turns follow in their order. A record without turns keeps one row, whose part is null. dropped: the paths of what the turns don't show."""
    kind = pa.struct([("layout", pa.string()), ("fingerprint", pa.string()), ("dropped", pa.list_(pa.string())), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])

    @F.arrow_udf("struct<layout:string,fingerprint:string,dropped:array<string>,turns:array<struct<role:string,text:string>>>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict = registry()
        for column in columns:
            out = []
            for text in column.to_pylist():
                data = _decoded(text)
                layout, own, gone = mapped(data, known)
                out.append({"layout": layout, "fingerprint": fingerprint(paths(data)) if isinstance(data, dict) else None, "dropped": gone, "turns": [{"role": r, "text": t} for r, t in own]})
                if len(known) > MOST_LAYOUTS:
                    known = registry()
            yield pa.array(out, kind)

    got = records.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), run(record).alias("_r"))
    parts = got.select("conv_id", "turn", F.col("_r.layout").alias("layout"), F.col("_r.fingerprint").alias("fingerprint"), F.col("_r.dropped").alias("dropped"), F.posexplode_outer("_r.turns").alias("part", "_t"))
    return parts.select("conv_id", "turn", "part", "layout", "fingerprint", "dropped", "_t.role", "_t.text")


def turns(rows: DataFrame) -> DataFrame:
    """The rows of turns_of() that are turns."""
    return rows.where("part is not null")


def layouts(rows: DataFrame) -> DataFrame:
    """How many records there are of each layout and fingerprint, unknown ones (null layout) included, and how many of them hold something that their turns don't show."""
    return rows.where("part is null or part = 0").groupBy("layout", "fingerprint").agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.size("dropped") > 0).alias("n_dropping"))


def dropped(rows: DataFrame) -> DataFrame:
    """(layout, path, n_records): what turns don't show, and in how many records."""
    return rows.where("part is null or part = 0").select("layout", F.explode("dropped").alias("path")).groupBy("layout", "path").agg(F.count(F.lit(1)).alias("n_records"))


_FORMATTED = pa.struct([("piece", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def formatted(rows: DataFrame) -> DataFrame:
    """conv_id, turn, part, and the formatted piece with its loss mask, of each turn of turns_of()."""

    @F.arrow_udf("struct<piece:string,loss_start:long,loss_end:long>")
    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for roles, texts in columns:
            made = [piece(r or "", t or "") for r, t in zip(roles.to_pylist(), texts.to_pylist())]
            yield pa.array([{"piece": p, "loss_start": a, "loss_end": b} for p, a, b in made], _FORMATTED)

    return turns(rows).select("conv_id", "turn", "part", run("role", "text").alias("_f")).select("conv_id", "turn", "part", "_f.*")


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(pieces: DataFrame) -> DataFrame:
    """Read the pieces back, conversation by conversation in turn order, holding one piece at a time."""
    names = [x.split()[0] for x in _DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done():
            n, said, loss, chars, total = state
            return (now[0], n, said.hexdigest(), chars, loss.hexdigest(), total)

        for batch in batches:
            out = []
            for conv, text, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now != (conv,):
                    if now is not None:
                        out.append(done())
                    now, state = (conv,), [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                role, body = map(unescape, _PIECE.fullmatch(text).groups())
                under = unescape(text[a:b])
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[2].update(under.encode())
                state[3] += len(under)
                state[4] += len(text)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string() if i in (2, 4) else pa.int64()) for i in range(6)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string() if i in (2, 4) else pa.int64()) for i, v in enumerate(done())], names)

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "piece")
    return ordered.select(F.col("conv_id").cast("long"), "piece", "loss_start", "loss_end").mapInArrow(run, _DIGEST)


def op4_chat(spark, sf_dir: str) -> DataFrame:
    own = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(more)
    records = rows.select("conv_id", "turn", F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    return digests(formatted(turns_of(records, "conv_id", "turn", "record")))


SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
     t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

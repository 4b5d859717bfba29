"""Chat formatting from event logs.

Events: (conv_id, seq, turn, kind, role, text).  Within a conversation they apply in the order of seq:
``open`` starts a message at ``turn`` (an open one there is replaced) with a role and a first text,
``delta`` appends its text to the message at ``turn``, ``edit`` replaces that message's text, and
``regenerate`` discards the message at ``turn`` and all later turns; what follows builds them anew.  A
delta or edit for a turn with no message is ignored.

Fold: the log is partitioned by conversation and streams past sorted by turn and, within a turn, by sequence.  One
message is open at a time and takes its openings, deltas and edits in the order of seq.  What a regeneration discards at
later turns is every event there that came before it, so of all regenerations at earlier turns only the latest matters: the
fold carries that one mark along, and the result is that of applying the whole log in the order of seq.  A task holds one
batch and one message, however long the conversation.

Template: a message renders as ``<|role|>`` + role + newline + text + ``<|end|>`` + newline.  In roles and
texts a ``<`` followed by any number of backslashes and ``|`` gets one backslash more before the ``|`` (and a newline
in a role becomes ``<|nl|>``), so control strings inside texts stay texts and can be read back exactly.  Loss spans mark the text of assistant messages.

Nulls: a null text is empty, a null role is the empty role; events with a null conversation, sequence or
turn are left out.  Repeated events (equal in all columns) apply as often as they stand; equal seq
values are ordered by turn, kind, role and text.  Conversations without a message give no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillroll.llm.common import small_batches

ROLE, END, NEWLINE = "<|role|>", "<|end|>\n", "<|nl|>"
LOSS_ROLES = ("assistant",)


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final messages."""
    log = (events.select("conv_id", "seq", "turn", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
           .where("conv_id is not null and seq is not null and turn is not null"))
    names = ["conv_id", "turn", "role", "text"]

    def run(batches):
        at, cut, message = None, None, None  # (conversation, turn), the latest regeneration so far, [role, texts]
        for batch in batches:
            out = []
            for conv, seq, turn, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "turn", "kind", "role", "text"))):
                if at != (conv, turn):
                    if message:
                        out.append((*at, message[0], "".join(message[1])))
                    if at is None or at[0] != conv:
                        cut = None
                    at, message = (conv, turn), None
                now = (_ordered(seq), turn, kind is not None, kind or "", role, text)
                if kind == "regenerate":
                    cut, message = now if cut is None else max(cut, now), None
                elif cut is not None and now < cut:
                    continue  # discarded by a regeneration that came later
                elif kind == "open":
                    message = [role, [text]]
                elif message and kind == "delta":
                    message[1].append(text)
                elif message and kind == "edit":
                    message[1] = [text]
            yield _batch(out, names, types)
        if message:
            yield _batch([(*at, message[0], "".join(message[1]))], names, types)

    fields = {f.name: f.dataType for f in log.schema.fields}
    types = [to_arrow_type(fields[c]) for c in names]
    order = ["conv_id", "turn", "seq", "kind", "role", "text"]
    return (small_batches(log).repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(run, ", ".join(f"{c} {fields[c].simpleString()}" for c in names)))


def _ordered(value):
    """A sequence value (a number or text, or a struct of them) that compares as Spark sorts it."""
    return tuple((v is not None, v) for v in value.values()) if isinstance(value, dict) else value


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: str) -> str:
    """The text that ``escaped`` was given."""
    out, at = [], 0
    while (i := text.find("<\\", at)) >= 0:
        j = i + 1
        while j < len(text) and text[j] == "\\":
            j += 1
        if j < len(text) and text[j] == "|":
            out.append(text[at:i + 1] + text[i + 2: j + 1])
            at = j + 1
        else:
            out.append(text[at:j])
            at = j
    return "".join(out) + text[at:]


def rendered(messages: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, turn, piece, loss_start, loss_end): one formatted piece per message; a conversation
    is its pieces in the order of turn.  The loss span (code points inside the piece, end exclusive) is null outside
    the loss mask."""
    head = F.concat(F.lit(ROLE), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    body = escaped(F.col("text"))
    in_loss = F.col("role").isin(*loss_roles)
    return messages.select("conv_id", "turn", F.concat(head, body, F.lit(END)).alias("piece"),
                           F.when(in_loss, F.length(head)).alias("loss_start"), F.when(in_loss, F.length(head) + F.length(body)).alias("loss_end"))


def conversations(pieces: DataFrame) -> DataFrame:
    """(conv_id, formatted): each conversation as one text, which is as long as the conversation."""
    return (pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "piece"))).alias("all"))
            .select("conv_id", F.expr("concat_ws('', transform(all, x -> x.piece))").alias("formatted")))


def read_back(pieces: DataFrame, placed: bool = False) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the output
    alone.  The pieces stream past in order, one at a time; digests are built up as they go, so a
    conversation of any length needs the memory of one piece.  ``placed``: the pieces come straight from
    ``rendered(messages(...))``, whose fold leaves every conversation in one partition and in the order of turn,
    so they need no second exchange and sort; anything else (a written table, a join) needs both."""
    def run(batches):
        now, state = None, None

        def row():
            return (now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            out = []
            cols = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end")]
            for conv, piece, lo, hi in zip(*cols):
                if conv != now:
                    if state:
                        out.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = piece[len(ROLE): -len(END)].split("\n", 1)
                state[0] += 1
                state[1].update(f"{unescaped(role.replace(NEWLINE, '\n'))}\n{unescaped(text)}\n".encode())
                if lo is not None:
                    learnt = unescaped(piece[lo:hi])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(piece)
            yield _batch(out, names, types)
        if state:
            yield _batch([row()], names, types)

    of = pieces.schema["conv_id"].dataType
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [to_arrow_type(of), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    pieces = small_batches(pieces.select("conv_id", "turn", "piece", "loss_start", "loss_end"))
    return ((pieces if placed else pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn"))
            .mapInArrow(run, f"conv_id {of.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def events_of(rows: DataFrame, piece_chars: int = 200) -> DataFrame:
    """A streamed log of finished ``rows`` (conv_id, turn, role, text) in three passes over each conversation: every turn
    is opened and drafted; every fourth turn is regenerated, which discards it and the drafts of all later turns, and all
    turns are opened again, those of the assistant with their text in deltas; last, the other turns are edited and get theirs,
    while later turns stand.  Rows of one turn keep the order of role and text.  This only gives rows in the log's schema."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long")
    each = rows.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), place.alias("turn"))
    each = each.withColumn("late", F.expr("cast(role != 'assistant' as int)"))  # one event more: the edit
    each = each.select("*", F.explode(F.expr(f"sequence(0, 3 + late + cast(ceil(length(text) / {piece_chars}) as int))")).alias("i"))
    part = F.expr(f"substring(text, if(i = 1, 0, i - 4 - late) * {piece_chars} + 1, {piece_chars})")
    kind = F.expr("case when i = 2 and turn % 4 = 1 then 'regenerate' when i in (0, 2, 3) then 'open' when i = 4 and late = 1 then 'edit' else 'delta' end")
    seq = F.struct(F.expr("case when i < 2 then 1 when i < 4 or late = 0 then 2 else 3 end").alias("pass"), "turn", "i")
    return each.select("conv_id", seq.alias("seq"), "turn", kind.alias("kind"), "role",
                       F.when(F.col("i").isin(0, 2, 3) | (kind == "edit"), "").otherwise(part).alias("text"))

"""Chat formatting: roles of a raw transcript's lines by a hidden Markov model.

A transcript is a sequence of lines. A hidden state is a role and whether the line opens a turn or
continues one. What is seen of a line: the class of a speaker marker at its start (``MARKERS``, or
a name that is none of them), whether it is blank, whether the line before was, its length, how it
ends, and what it starts with (list, code, heading, digit). Features are independent given the
state. Start, transition and emission counts are gathered in Spark over all labelled transcripts
and mixed with what all roles have in common; Viterbi finds the likeliest states. A turn's first line with text loses
a marker of the turn's role, other lines stay whole, blank lines around them go, and the turn is rendered in one canonical form.

Lines are sorted within their transcript and decoded as a stream. Back pointers are dropped as soon
as all surviving paths agree on them, so a transcript of any length is decoded exactly in memory
that follows the stretch still open, and a hot one costs no more than its sorted lines and the
text of one turn.

Defined cases: a null line is blank; a null transcript id is one transcript; lines of equal place
come in order of their text; a transcript that is blank throughout has no turns; roles unknown to
the model are not learned from; a model without labelled lines has equal odds everywhere; an empty
table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
STATES = [(r, opens) for r in range(len(ROLES)) for opens in (True, False)]
#: The part of a role's odds that all roles share.
SHARED = 0.1
#: What a count that never occurred is worth.
UNSEEN = 0.1
#: Words that mark a speaker.
MARKERS = {
    "system": 1, "sys": 1, "instruction": 1, "instructions": 1, "context": 1,
    "user": 2, "human": 2, "customer": 2, "question": 2, "q": 2, "prompt": 2, "me": 2, "you": 2, "client": 2,
    "assistant": 3, "ai": 3, "bot": 3, "model": 3, "answer": 3, "a": 3, "agent": 3, "response": 3, "gpt": 3, "chatbot": 3,
}
_MARKED = re.compile(r"\s*(?:#{1,6}\s*|\*\*|\[|<\|?)?\s*([^\W\d_]{1,12})\s*(?:\*\*\s*:|:\s*\*\*|\|?>|\]\s*:?|:)\s*|\s*#{1,6}\s*([^\W\d_]{1,12})\s*$")
#: Values of each feature: marker, blank, blank before, length, end, start.
FEATURES = (5, 2, 3, 4, 4, 5)


def seen(line: str, before: str | None) -> tuple[tuple[int, ...], int]:
    """(features, length of the marker)."""
    m = _MARKED.match(line)
    word = ((m[1] or m[2]) if m else "").lower()
    marker = MARKERS.get(word, 4 if m else 0)
    body = line.strip()
    n = len(body)
    last, first = body[-1:], body[:1]
    end = 0 if not body else 1 if last == "?" else 2 if last in ".!" else 3
    start = 1 if first in "-*•" and first else 2 if body.startswith("```") else 3 if first == "#" else 4 if first.isdigit() else 0
    blank_before = 2 if before is None else int(not before.strip())
    return (marker, int(n == 0), blank_before, (n > 0) + (n > 40) + (n > 200), end, start), (m.end() if m and marker in (1, 2, 3) else 0)


class Model:
    """Log odds of start, transition and emission."""

    def __init__(self, counts: dict[tuple[int, int, int], int]):
        n = len(STATES)
        start, move = np.full(n, UNSEEN), np.zeros((n, n))
        emit = [np.zeros((n, values)) for values in FEATURES]
        for (kind, a, b), c in counts.items():
            if kind == -2:
                start[b] += c
            elif kind == -1:
                move[a, b] += c
            else:
                emit[kind][a, b] += c
        self._pool(move, emit)
        for i, (role, opens) in enumerate(STATES):
            if not opens:
                start[i] = 0  # a transcript opens with a turn
            for j, (to, to_opens) in enumerate(STATES):
                if not to_opens and to != role:
                    move[i, j] = 0  # only an opening line changes the role
        with np.errstate(divide="ignore"):
            self.start = np.log(start / start.sum())
            self.move = np.log(move / move.sum(axis=1, keepdims=True))
            self.emit = [np.log(e / e.sum(axis=1, keepdims=True)) for e in emit]
        self._memory: dict[tuple[int, ...], np.ndarray] = {}

    @staticmethod
    def _pool(move: np.ndarray, emit: list[np.ndarray]) -> None:
        """Makes counts odds of which ``SHARED`` comes from all roles, so that what none has shown is as odd for each."""

        def mixed(counts: np.ndarray, common: np.ndarray) -> np.ndarray:
            total = counts.sum(axis=1, keepdims=True)
            own = np.where(total > 0, counts / np.maximum(total, 1), common)
            return (1 - SHARED) * own + SHARED * common

        for opens in (True, False):
            alike = [i for i, s in enumerate(STATES) if s[1] == opens]
            for f, counts in enumerate(emit):
                common = counts[alike].sum(axis=0) + UNSEEN
                if f == 0 and opens:
                    common = np.ones(len(common))  # markers of opening lines are a role's own
                counts[alike] = mixed(counts[alike], common / common.sum())
            going = [STATES.index((STATES[i][0], False)) for i in alike]
            stay = (move[alike, going].sum() + UNSEEN) / (move[alike].sum() + 2 * UNSEEN)
            common = np.array([[stay if j == g else (1 - stay) * s[1] / len(ROLES) for j, s in enumerate(STATES)] for g in going])
            move[alike] = mixed(move[alike], common)

    def odds(self, features: tuple[int, ...]) -> np.ndarray:
        found = self._memory.get(features)
        if found is None:
            found = self._memory[features] = sum(e[:, v] for e, v in zip(self.emit, features, strict=True))
        return found


class Decoder:
    """Viterbi over lines as they come; ``step`` and ``end`` give the states that are certain."""

    def __init__(self, model: Model):
        self.model, self.score, self.back = model, None, []

    def step(self, features: tuple[int, ...]) -> list[int]:
        odds = self.model.odds(features)
        if self.score is None:
            self.score, self.back = self.model.start + odds, []
            return []
        paths = self.score[:, None] + self.model.move
        best = paths.argmax(axis=0)
        self.score = paths[best, np.arange(len(best))] + odds
        self.score -= self.score.max()
        self.back.append(best)
        return self._settled() if len(self.back) % 64 == 0 else []

    def _settled(self) -> list[int]:
        """States of the first lines if all living paths go through one state."""
        alive = np.flatnonzero(np.isfinite(self.score))
        at = len(self.back)
        while at > 0 and len(alive) > 1:
            at -= 1
            alive = np.unique(self.back[at][alive])
        if len(alive) > 1 or at == 0:
            return []
        # the path is one up to line ``at``; that line stays open, as the start of what is left
        states = self._trace(int(alive[0]), at)
        self.back = self.back[at:]
        return states[:-1]

    def _trace(self, state: int, at: int) -> list[int]:
        out = [state]
        for best in reversed(self.back[:at]):
            out.append(int(best[out[-1]]))
        return out[::-1]

    def end(self) -> list[int]:
        if self.score is None:
            return []
        out = self._trace(int(self.score.argmax()), len(self.back))
        self.score, self.back = None, []
        return out


def learn(lines: DataFrame) -> Model:
    """Counts over labelled lines (conv, place, line, role, opens): a fixed number of them reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, before, state, fresh = None, None, -1, True
        for batch in batches:
            counts: dict[tuple[int, int, int], int] = {}
            for c, line, role, opens in zip(*(batch[k].to_pylist() for k in ("conv", "line", "role", "opens")), strict=True):
                if fresh or c != conv:
                    conv, before, state, fresh = c, None, -1, False
                line = line or ""
                if role in ROLES:
                    now = STATES.index((ROLES.index(role), bool(opens)))
                    keys = [(-2, 0, now) if before is None else (-1, state, now)] if before is None or state >= 0 else []
                    for key in keys + [(f, now, v) for f, v in enumerate(seen(line, before)[0])]:
                        counts[key] = counts.get(key, 0) + 1
                    state = now
                else:
                    state = -1
                before = line
            if counts:
                columns = [pa.array(c, pa.int32()) for c in zip(*counts, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(counts.values()), pa.int64())], ["kind", "a", "b", "n"])

    counted = _in_order(lines.select("conv", "place", "line", "role", "opens")).mapInArrow(count, "kind int, a int, b int, n long")
    rows = counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()
    return Model({(r["kind"], r["a"], r["b"]): r["n"] for r in rows})


def _in_order(lines: DataFrame) -> DataFrame:
    return lines.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place", "line")


def rendered(role: Column, body: Column) -> Column:
    """The canonical form of a turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("\n<|end|>\n"))


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """Turns of the transcripts with lines (conv, place, line): conv, turn, role, n_lines, body, rendered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        waiting: list[tuple[str, int, int]] = []  # lines whose states are open, length of their marker and its role
        turn: list[str] = []
        conv, fresh, before, number, role, bare = None, True, None, 0, -1, True  # bare: no line of the turn has text
        out: list[list] = [[], [], [], [], []]

        def close() -> None:
            nonlocal number, bare
            body = "\n".join(turn).strip("\n")
            if body.strip():
                for column, value in zip(out, (conv, number, ROLES[role], body.count("\n") + 1, body), strict=True):
                    column.append(value)
                number += 1
            turn.clear()
            bare = True

        def settle(states: list[int]) -> None:
            nonlocal role, bare
            for state, (line, marker, marked) in zip(states, waiting, strict=False):
                r, opens = STATES[state]
                if opens or r != role:
                    close()
                role = r
                turn.append(line[marker:] if bare and r == marked else line)
                bare = bare and not line.strip()
            del waiting[: len(states)]

        def flush() -> pa.RecordBatch:
            types = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string())
            ready = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["conv", "turn", "role", "n_lines", "body"])
            for column in out:
                column.clear()
            return ready

        conv_type = pa.int64()
        for batch in batches:
            conv_type = batch.schema.field("conv").type
            for c, line in zip(batch["conv"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if fresh or c != conv:
                    settle(decoder.end())
                    close()
                    conv, fresh, before, number, role = c, False, None, 0, -1
                line = line or ""
                features, marker = seen(line, before)
                waiting.append((line, marker, features[0] - 1))
                settle(decoder.step(features))
                before = line
                if len(out[0]) >= 1_000:
                    yield flush()
        settle(decoder.end())
        close()
        if out[0]:
            yield flush()

    kind = lines.schema["conv"].dataType.simpleString()
    ordered = _in_order(lines.select("conv", "place", "line"))
    turns = ordered.mapInArrow(run, f"conv {kind}, turn long, role string, n_lines long, body string")
    return turns.withColumn("rendered", rendered(F.col("role"), F.col("body")))


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Transcripts as people paste them, from turns (conv_id, turn, role, text), with the truth beside each line.

    The way that speakers are marked follows from the conversation's hash; one turn in eight, but the
    first, has no marker but a blank line before it.
    """
    styles = [
        {"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
        {"system": "Instruction: ", "user": "Human: ", "assistant": "AI: "},
        {"system": "[system] ", "user": "[user] ", "assistant": "[assistant] "},
        {"system": "### System: ", "user": "### Human: ", "assistant": "### Assistant: "},
        {"system": "Context: ", "user": "Q: ", "assistant": "A: "},
        {"system": "<|system|> ", "user": "<|user|> ", "assistant": "<|assistant|> "},
        {"system": "**System**: ", "user": "**Customer**: ", "assistant": "**Agent**: "},
    ]
    style = F.pmod(F.xxhash64(F.lit(1), "conv_id"), F.lit(len(styles)))
    mark = F.coalesce(*[F.when(style == i, F.coalesce(*[F.when(F.col("role") == r, F.lit(w)) for r, w in s.items()])) for i, s in enumerate(styles)], F.lit(""))
    unmarked = (F.pmod(F.xxhash64(F.lit(2), "conv_id", "turn"), F.lit(8)) == 0) & (F.coalesce("turn", F.lit(0)) > 0)
    text = F.coalesce("text", F.lit(""))
    whole = F.when(unmarked, F.concat(F.lit("\n"), text)).otherwise(F.concat(mark, text))
    lines = conversations.select(F.col("conv_id").alias("conv"), "turn", "role", F.xxhash64("role", "text").alias("tie"), F.posexplode(F.split(whole, "\n")).alias("at", "line"))
    # the blank line before an unmarked turn opens it
    place = F.struct("turn", "tie", "at")
    return lines.select("conv", place.alias("place"), "line", "role", (F.col("at") == 0).alias("opens"))


def agreement(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each true turn with text: true_role, and the role of a recovered turn of the same text (null: none)."""
    body = F.trim(F.col("text"), F.lit("\n"))
    truth = conversations.where("trim(text) <> ''").select(F.col("conv_id").alias("conv"), body.alias("body"), F.col("role").alias("true_role"))
    found = turns.groupBy("conv", "body").agg(F.min("role").alias("role"))
    return truth.join(found, ["conv", "body"], "left")

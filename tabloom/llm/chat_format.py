"""Chat formatting by assembling token ids.

A turn becomes ``<s>role[INST]text[/INST]</s>``.  The four control strings are
reserved ids above the vocabulary, spliced between separately encoded
segments, so no text can ever produce them.  In the readable form, a control
string occurring in a role or text gets a backslash after its first character
(``<\\/s>``, one more if it has some), which is undone on reading.

The loss mask marks the tokens of the assistant's text: segment lengths become
+1 and -1 at segment borders, and their running sum is the mask.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.words import bound_batches, text_slices

TURN, OPEN, CLOSE, END = CONTROLS = ("<s>", "[INST]", "[/INST]", "</s>")
TRAINED_ROLE = "assistant"
_MARKED = re.compile(r"<\\*/?s>|\[\\*/?INST\]")
_ESCAPED = re.compile(r"<\\+/?s>|\[\\+/?INST\]")
_SEGMENT = 1 << 16
#: Before a space that follows a letter, digit or underscore the split pattern always has a border.
_BORDER = re.compile(r"(?<=\w) ")


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class ChatTokenizer:
    """A byte-level BPE vocabulary with the control strings as ids above it."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 1
        self.reserved = {name: first + k for k, name in enumerate(CONTROLS)}

    def encode(self, text: str) -> list[int]:
        """The ids of the whole text, taken in segments that end where the split pattern has a border anyway."""
        out: list[int] = []
        start = 0
        while start < len(text):
            border = _BORDER.search(text, start + _SEGMENT)
            stop = border.start() if border else len(text)
            out += self.encoding.encode_ordinary(text[start:stop])
            start = stop
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode()

    def format_turn(self, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, loss mask) of one turn."""
        r = self.reserved
        segments = [[r[TURN]], self.encode(escape(role)), [r[OPEN]], self.encode(escape(text)), [r[CLOSE], r[END]]]
        borders = np.cumsum([0] + [len(s) for s in segments])
        edges = np.zeros(borders[-1] + 1, dtype=np.int64)
        if role == TRAINED_ROLE:
            edges[borders[3]] += 1
            edges[borders[4]] -= 1
        return np.array([i for s in segments for i in s], dtype=np.int32), np.cumsum(edges[:-1]).astype(bool)

    def read_turn(self, ids: np.ndarray) -> tuple[str, str]:
        """(role, text) of the ids of one turn."""
        r = self.reserved
        start, stop = int(np.flatnonzero(ids == r[OPEN])[0]), int(np.flatnonzero(ids == r[CLOSE])[-1])
        return unescape(self.decode(ids[1:start])), unescape(self.decode(ids[start + 1:stop]))

    def render(self, ids: np.ndarray) -> str:
        """The readable form of formatted ids."""
        names = {i: name for name, i in self.reserved.items()}
        out, cuts = [], np.flatnonzero(ids >= min(names))
        last = 0
        for k in cuts:
            out += [self.decode(ids[last:k]), names[int(ids[k])]]
            last = int(k) + 1
        return "".join(out) + self.decode(ids[last:])


@dataclass(frozen=True)
class Vocabulary:
    """Where an executor finds the vocabulary file and the split pattern."""

    path: Callable[[], str]
    pattern: Callable[[], str]


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


DEFAULT_VOCABULARY = Vocabulary(_default_path, _default_pattern)
_tokenizers: dict[str, ChatTokenizer] = {}


def tokenizer(vocabulary: Vocabulary) -> ChatTokenizer:
    path = vocabulary.path()
    if path not in _tokenizers:
        _tokenizers[path] = ChatTokenizer(path, vocabulary.pattern())
    return _tokenizers[path]


def format_turns(conversations: DataFrame, vocabulary: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """(conv_id, turn, role, text, ids, loss) for every row; ids and loss are arrays of one length.

    A null role or text is empty.  Turns are formatted one by one, so a
    conversation of any length is spread over all tasks; its formatted form is
    its turns in the order of turn, role and text (nulls first).
    """
    bound_batches(conversations.sparkSession)
    wanted = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        own = tokenizer(vocabulary)
        for batch in text_slices(batches):
            done = [own.format_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            offsets = pa.array(np.cumsum([0] + [len(ids) for ids, _ in done]), pa.int32())
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([ids for ids, _ in done]), pa.int32()))
            loss = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([mask for _, mask in done]), pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, loss], names=["conv_id", "turn", "role", "text", "ids", "loss"])

    return wanted.mapInArrow(run, "conv_id long, turn long, role string, text string, ids array<int>, loss array<boolean>")


def read_back(formatted: DataFrame, vocabulary: Vocabulary = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per conversation, from ids and loss masks alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).
    Turns are decoded, rendered and unescaped one by one, wherever they are.
    The digests run over a whole conversation in order, so its read turns pass
    through one task as a stream: rows are sorted, and only the state of the
    digests is held.
    """

    def read(batches):
        own = tokenizer(vocabulary)
        for batch in batches:
            said, trained, sizes = [], [], []
            for ids, loss in zip(batch.column("ids"), batch.column("loss")):
                ids, loss = ids.values.to_numpy(), np.asarray(loss.values)
                role, text = own.read_turn(ids)
                said.append(f"{role}\n{text}\n")
                trained.append(unescape(own.decode(ids[loss])))
                sizes.append(len(own.render(ids)))
            keys = [batch.column(c) for c in ("conv_id", "turn", "role", "text")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(said, pa.string()), pa.array(trained, pa.string()), pa.array(sizes, pa.int64())],
                                             names=["conv_id", "turn", "role", "text", "said", "trained", "formatted"])

    turns = formatted.select("conv_id", "turn", "role", "text", "ids", "loss").mapInArrow(
        read, "conv_id long, turn long, role string, text string, said string, trained string, formatted long")
    in_order = (turns.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")])
                .select("conv_id", "said", "trained", "formatted"))

    def run(batches):
        current, state = None, None

        def closed():
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int64()), pa.array([state["turns"]], pa.int64()), pa.array([state["all"].hexdigest()]), pa.array([state["chars"]], pa.int64()),
                 pa.array([state["loss"].hexdigest()]), pa.array([state["formatted"]], pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, said, trained, size in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or conv != current:
                    if state is not None:
                        yield closed()
                    current, state = conv, {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "formatted": 0}
                state["turns"] += 1
                state["all"].update(said.encode())
                state["loss"].update(trained.encode())
                state["chars"] += len(trained)
                state["formatted"] += size
        if state is not None:
            yield closed()

    return in_order.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    said = f"{END}{OPEN} ok {CLOSE}"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


#: The same digests straight from the table.
CHAT_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
escaped as (
    select *, regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') as safe_role,
        regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g') as safe_text
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
    sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
    cast(sum(20 + length(safe_role) + length(safe_text)) as bigint) as formatted_chars
from escaped group by conv_id
"""

"""SentencePiece BPE encoding with a table of each prefix's last token, and decoding.

For a chunk of text, every prefix's encoding ends in exactly one token.  That
token is found among the vocabulary pieces that end at the prefix (an
Aho-Corasick automaton lists them): it is the one that is compatible with the
last token of what stands before it, which means that merging the two tokens'
characters by priority would end in just these two.  Walking back from the end
of the chunk recovers the ids.  Time and memory are linear in the chunk.

No piece reaches across the start of a word (a non-space followed by a space)
or a character the vocabulary lacks, so words are independent chunks; each
worker keeps the results of the words it has met, up to a fixed number.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tabloom.llm.words import bound_batches, text_slices

SPACE = "▁"
_LEAF = -1
_CACHE_WORDS = 250_000
_CACHE_PAIRS = 300_000
#: Longer words, and parts of words, are encoded anew each time.
_CACHE_CHARS = 64


class PieceModel:
    """The pieces of a SentencePiece BPE model with byte fallback, and the tables of the encoder."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = {i for i in range(len(pieces)) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.byte_ids = {int(pieces[i][3:5], 16): i for i in range(len(pieces)) if model.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.text_of = pieces
        self.hidden = {i for i in range(len(pieces)) if model.is_control(i)}
        self.plain_text = set(range(len(pieces))) - self.hidden - set(self.bytes_of)
        self.ids = {pieces[i]: i for i in range(len(pieces)) if i not in special}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        # Runs of spaces share one lowest score; merging them gives the longest run first.
        self.space_runs = {len(p) for p in self.ids if p.strip(SPACE) == ""}
        words = {p: i for p, i in self.ids.items() if p.strip(SPACE) or p == SPACE}
        if any(SPACE in p[1:] for p in words):
            raise ValueError("a piece reaches into the next word")
        order = sorted((i for p, i in words.items() if len(p) > 1), key=lambda i: -model.get_score(i))
        self.rank = {i: k for k, i in enumerate(order)}
        self.rank |= {i: _LEAF for p, i in words.items() if len(p) == 1}
        lowest = min((model.get_score(i) for i in order), default=0)
        if any(model.get_score(self.ids[SPACE * n]) >= lowest for n in self.space_runs if n > 1):
            raise ValueError("runs of spaces are merged before words")
        self.pairs = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.letters = {p for p in words if len(p) == 1 and p != SPACE}
        self.newline = "\n" not in "".join(self.ids)
        self.split: dict[int, tuple[int, int]] = {}
        self._compatible: dict[int, bool] = {}
        self._build(words, order)

    def _build(self, words: dict[str, int], order: list[int]) -> None:
        """Record how each piece is merged last; a piece that merging never reaches is left out of the automaton."""
        self.automaton = ahocorasick.Automaton()
        for piece, i in words.items():
            if len(piece) == 1:
                self.automaton.add_word(piece, (i, 1))
        for i in order:
            piece = self.text_of[i]
            halves = self._last_merge(piece)
            if halves:
                self.split[i] = halves
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two tokens that merging ``piece`` alone joins last; None if it does not end in one token."""
        parts = list(piece)
        if any(c not in self.ids for c in parts):
            return None
        while len(parts) > 1:
            best = min(((self.rank[self.ids[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if self.ids.get(a + b) in self.rank), default=None)
            if best is None:
                return None
            k = best[1]
            if len(parts) == 2:
                return self.ids[parts[0]], self.ids[parts[1]]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both tokens ends in exactly this pair.

        The merges of both are undone, latest first.  At each point a merge
        across the border would have come first if its rank is lower than that
        of the merge just undone, or equal and further left; then the pair
        cannot arise.
        """
        if len(self._compatible) > _CACHE_PAIRS:
            self._compatible.clear()
        found = self._compatible[left << 32 | right] = self._undo(left, right)
        return found

    def _undo(self, left: int, right: int) -> bool:
        rank, split, text, ids = self.rank, self.split, self.text_of, self.ids
        before = None  # (rank, whether a merge across of the same rank would precede) of the merge undone last
        while True:
            across = ids.get(text[left] + text[right])
            if across is not None and across in split:
                if before is None or rank[across] < before[0] or (rank[across] == before[0] and before[1]):
                    return False
            if rank[left] == _LEAF and rank[right] == _LEAF:
                return True
            # Of merges of one rank the left one comes first, so the right one is undone first.
            if rank[left] > rank[right]:
                before = (rank[left], False)
                left = split[left][1]
            else:
                before = (rank[right], True)
                right = split[right][0]

    def word_ids(self, word: str) -> list[int]:
        """Tokens of a chunk whose characters the vocabulary knows, with a space at its start at most."""
        last, size = [-1] * (len(word) + 1), [0] * (len(word) + 1)
        known = self._compatible
        for end, (token, n) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            if n < end:
                before = last[end - n]
                fits = known.get(before << 32 | token)
                if fits is None:
                    fits = self.compatible(before, token)
                if not fits:
                    continue
            last[end], size[end] = token, n
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def _run_ids(self, n: int) -> list[int]:
        """Tokens of n spaces: the longest run in the vocabulary first, again and again."""
        out = []
        for size in sorted(self.space_runs, reverse=True):
            count, n = divmod(n, size)
            out += [self.ids[SPACE * size]] * count
        return out

    def chunk_ids(self, chunk: str) -> list[int]:
        """Tokens of any chunk: spaces, then characters other than spaces."""
        body = chunk.lstrip(SPACE)
        spaces = len(chunk) - len(body)
        if body and spaces < 2 and self.letters.issuperset(body):
            return self.word_ids(chunk)
        out: list[int] = []
        known = self.ids
        pending = SPACE if spaces and body else ""
        run: list[str] = [pending]
        tail: list[int] = []
        for c in body:
            if c in known:
                run.append(c)
            else:
                word = "".join(run)
                if word:
                    tail.extend(self.word_ids(word))
                run = []
                tail.extend(self.byte_ids[b] for b in c.encode())
        if word := "".join(run):
            tail.extend(self.word_ids(word))
        alone = self.ids[SPACE]
        if pending and tail and tail[0] == alone:
            tail.pop(0)  # the last space joined no word, so it belongs to the run
            pending = ""
        if spaces - len(pending):
            out.extend(self._run_ids(spaces - len(pending)))
        return out + tail

    def decode(self, ids: list[int]) -> str:
        """Text of the tokens, spaces restored, without the space put before the first word."""
        if self.plain_text.issuperset(ids):
            text = "".join(map(self.text_of.__getitem__, ids)).replace(SPACE, " ")
            return text[1:] if text.startswith(" ") else text
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.bytes_of:
                held.append(self.bytes_of[i])
                continue
            if held:
                out.append(held.decode(errors="replace"))
                held.clear()
            if i not in self.hidden:
                out.append(self.text_of[i])
        if held:
            out.append(held.decode(errors="replace"))
        text = "".join(out).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


class _Words(dict):
    """Ids by word; when full, the older half is dropped unless it is asked for again."""

    def __init__(self, make: Callable[[str], str], limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit // 2, {}

    def __missing__(self, word: str) -> str:
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(word) > _CACHE_CHARS:
            return found
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Whole texts through a PieceModel, with the results of words met before.

    A word's result is its decimal ids, each after a comma.  Its ids are
    decoded when they are found; only a word that decodes to something else
    than itself keeps that text too.  Words at the start of a line carry no
    space.  Inside a word, two characters that stand side by side in no piece
    part it into words of their own, so "word," costs no second search; a word is
    cut at all of these places in one loop.
    """

    def __init__(self, model: PieceModel, words: int = _CACHE_WORDS):
        self.model = model
        self.spaced = _Words(lambda w: self._entry(SPACE, w), words)
        self.plain = _Words(lambda w: self._entry("", w), words // 2)
        self.altered: dict[tuple[str, str], str] = {}
        self.chunks = re.compile(f"({SPACE}*)([^{SPACE}]*)")
        self.decimal = [f",{i}" for i in range(len(model.text_of))]
        self.space_id = model.ids[SPACE]

    def _entry(self, lead: str, word: str) -> str:
        pairs = self.model.pairs
        cuts = [k for k in range(1, len(word)) if word[k - 1:k + 1] not in pairs]
        if cuts:
            first = self.spaced[word[:cuts[0]]] if lead else self.plain[word[:cuts[0]]]
            rest = [self.plain[word[a:b]] for a, b in zip(cuts, [*cuts[1:], len(word)])]
            found = "".join([first, *rest])
            if self.altered:
                self._note(lead, word, [int(i) for i in found.split(",")[1:]])
            return found
        ids = self.model.chunk_ids(lead + word)
        self._note(lead, word, ids)
        return "".join(map(self.decimal.__getitem__, ids))

    def _note(self, lead: str, word: str, ids: list[int]) -> None:
        text = self.model.decode([self.space_id, *ids])
        if text != (" " if lead else "") + word:
            self.altered[lead, word] = text

    def _decoded(self, lead: str, word: str) -> str:
        return self.altered.get((lead, word), (" " if lead else "") + word)

    def encode(self, text: str) -> tuple[int, str, str]:
        """(number of ids, decimal ids joined by commas, text decoded from them)."""
        if not text:
            return 0, "", ""
        lines = text.replace(SPACE, " ").split("\n") if self.model.newline else [text.replace(SPACE, " ")]
        between = self.decimal[self.model.byte_ids[10]]
        done = [self._line(line, bool(k)) for k, line in enumerate(lines)]
        ids, whole = between.join([d[0] for d in done]), "\n".join([d[1] for d in done])
        return ids.count(","), ids[1:], whole[1:] if whole.startswith(" ") else whole

    def _line(self, line: str, later: bool) -> tuple[str, str]:
        """(ids, decoded text) of one line; the first one has a space before it."""
        if later and not line:
            return "", ""
        words = line.split(" ")
        if "" in words:
            return self._wide_line(line if later else " " + line)
        decoded = line if later else " " + line
        ids = self.plain[words[0]] + "".join(map(self.spaced.__getitem__, words[1:])) if later else "".join(map(self.spaced.__getitem__, words))
        if self.altered:
            decoded = "".join([self._decoded("" if later and not k else SPACE, w) for k, w in enumerate(words)])
        return ids, decoded

    def _wide_line(self, line: str) -> tuple[str, str]:
        """A line with spaces side by side or at an end: spaces and the word after them go together."""
        ids: list[int] = []
        for spaces, word in self.chunks.findall(line.replace(" ", SPACE)):
            ids += self.model.chunk_ids(spaces + word) if spaces or word else []
        return "".join(map(self.decimal.__getitem__, ids)), self.model.decode([self.space_id, *ids])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a model file, built once."""
    if path not in _encoders:
        _encoders[path] = Encoder(PieceModel(path))
    return _encoders[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_texts(docs: DataFrame, model: Callable[[], str] = default_model, with_ids: bool = False, with_decoded: bool | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row of ``docs`` (doc_id, text).

    ``model`` gives the model file's path on the executor that runs it.  A null
    or empty text has no ids and decodes to the empty string.  Other columns
    are not read; repeated rows are encoded each.  The decoded texts come with
    the ids unless ``with_decoded`` says otherwise.
    """
    bound_batches(docs.sparkSession)
    with_decoded = with_ids if with_decoded is None else with_decoded
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def run(batches):
        own = encoder(model())
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        for batch in text_slices(batches):
            found = [own.encode(t or "") for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array([f[0] for f in found], pa.int64()),
                       pa.array([digest(f[1]) for f in found], pa.string()), pa.array([digest(f[2]) for f in found], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns += [pa.array([np.fromstring(f[1], dtype=np.int32, sep=",") for f in found], pa.list_(pa.int32()))]
                names += ["ids"]
            if with_decoded:
                columns += [pa.array([f[2] for f in found], pa.string())]
                names += ["decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, kind)

"""Operator 1: token counts by compiled finite-state transducers.

Two deterministic transducers count byte-level BPE tokens without encoding:

* the **cutter** reads character classes and marks where words start. It has
  ten states, so a chunk of text is a map from ten start states to ten end
  states. Chunks are run side by side for every start state, their maps are
  composed by a parallel prefix scan, and a last sweep from the now known start
  states emits the marks;
* the **counter** reads the bytes of a word; each transition carries the
  change in the number of emitted tokens. It is determinised on demand: a state
  is what the future can depend on, the unfinished token prefixes with the
  last token before each and its relative count.

Words are counted once per distinct word of a slice. Nothing is shuffled.
"""

from __future__ import annotations

import json
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.llm.bpe import Merges
from torque.llm.segments import distinct_segments, slices, sums_between
from torque.llm.worker_memory import Memo, kept

# ---- fixed values: the word pattern of the tokenizer family -----------------
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
          0x205F, 0x3000]
# -----------------------------------------------------------------------------

SEPARATOR = 0x110000  # stands between texts; no character has this number
CLASSES = ["letter", "s/t/m/d", "r/v", "e", "l", "number", "quote", "other", "blank", "white",
           "separator"]
LETTER, SHORT, LONG, E, L, NUMBER, QUOTE, OTHER, BLANK, WHITE, SEP = range(11)
STATES = ["fresh", "letters", "numbers", "others", "quote", "quote r/v", "quote l", "suffix",
          "blank", "white"]
FRESH, LETTERS, NUMBERS, OTHERS, QUOTED, QUOTED_RV, QUOTED_L, SUFFIX, BLANKS, WHITES = range(10)
HERE, BEFORE = 1, 2   # emitted marks: a word starts at this character, at the one before
LANE = 256


def _cutter() -> tuple[np.ndarray, np.ndarray]:
    """Transition and emission tables, indexed by state * classes + class."""
    move = np.zeros((len(STATES), len(CLASSES)), np.int8)
    emit = np.zeros_like(move)
    run_of = {LETTER: LETTERS, SHORT: LETTERS, LONG: LETTERS, E: LETTERS, L: LETTERS,
              NUMBER: NUMBERS, QUOTE: OTHERS, OTHER: OTHERS}
    for state in range(len(STATES)):
        for cls in range(len(CLASSES)):
            if cls == SEP:
                to, out = FRESH, HERE
            elif cls in (BLANK, WHITE):
                to = BLANKS if cls == BLANK else WHITES
                out = 0 if state in (BLANKS, WHITES) else HERE
            elif state == BLANKS:          # the last blank of a run joins what follows
                to, out = run_of[cls], BEFORE
            elif state in (QUOTED, QUOTED_RV, QUOTED_L) and run_of[cls] == LETTERS:
                if (state, cls) in ((QUOTED, SHORT), (QUOTED_RV, E), (QUOTED_L, L)):
                    to, out = SUFFIX, 0
                elif (state, cls) == (QUOTED, LONG):
                    to, out = QUOTED_RV, 0
                elif (state, cls) == (QUOTED, L):
                    to, out = QUOTED_L, 0
                else:                      # not a suffix: the quote stood alone
                    to, out = LETTERS, HERE if state == QUOTED else BEFORE
            else:
                held = {QUOTED: OTHERS, QUOTED_RV: LETTERS, QUOTED_L: LETTERS}.get(state, state)
                late = BEFORE if state in (QUOTED_RV, QUOTED_L) else 0
                to = run_of[cls]
                out = late | (0 if held == to else HERE)
                if state == WHITES:        # the last white of a run stands alone
                    out |= BEFORE
                if cls == QUOTE and out & HERE:
                    to = QUOTED
            if state in (QUOTED_RV, QUOTED_L) and cls in (BLANK, WHITE, SEP):
                out |= BEFORE
            move[state, cls], emit[state, cls] = to, out
    return move.ravel(), emit.ravel()


_CLASS_OF: np.ndarray | None = None


def class_table() -> np.ndarray:
    """Character class by code point."""
    global _CLASS_OF
    if _CLASS_OF is None:
        table = np.full(SEPARATOR + 1, OTHER, np.int8)
        kinds = np.frombuffer("".join(unicodedata.category(chr(c))[0]
                                      for c in range(sys.maxunicode + 1)).encode(), np.uint8)
        table[:-1][kinds == ord("L")] = LETTER
        table[:-1][kinds == ord("N")] = NUMBER
        table[SPACES] = WHITE
        table[32], table[ord("'")], table[SEPARATOR] = BLANK, QUOTE, SEP
        for chars, cls in (("stmd", SHORT), ("rv", LONG), ("e", E), ("l", L)):
            table[[ord(c) for c in chars]] = cls
        _CLASS_OF = table
    return _CLASS_OF


MOVE, EMIT = _cutter()


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps, in log2(n) rounds.

    ``maps[i, s]`` is the state after chunk i when it starts in s; the result
    has the state after chunks 0..i.
    """
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step].astype(np.int64), axis=1)
        step *= 2
    return out


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Marks (bool per character) of where words start, by the chunked cutter."""
    n, width = len(classes), len(CLASSES)
    lanes = -(-n // LANE)
    padded = np.full(lanes * LANE, SEP, np.int8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(lanes, LANE).T.astype(np.intp))
    states = np.tile(np.arange(len(STATES), dtype=np.int8), (lanes, 1))
    for column in columns:                 # every chunk from every start state
        states = MOVE[states.astype(np.intp) * width + column[:, None]]
    ends = compose_scan(states)
    state = np.concatenate(([FRESH], ends[:-1, FRESH])).astype(np.intp)
    emitted = np.empty((LANE, lanes), np.int8)
    for j, column in enumerate(columns):   # once more, from the known states
        at = state * width + column
        emitted[j] = EMIT[at]
        state = MOVE[at].astype(np.intp)
    flags = emitted.T.ravel()[:n]
    marks = (flags & HERE) != 0
    marks[:-1] |= (flags[1:] & BEFORE) != 0
    return marks


class Counter:
    """The lazily determinised counting transducer of one BPE vocabulary."""

    MAX_STATES, WORD_BYTES = 200_000, 64_000_000   # bounds of what a worker remembers

    def __init__(self, vocabulary_json: bytes):
        spec = json.loads(vocabulary_json)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if (model["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError(f"unsupported added token {token['content']!r}")
        self.specials = [t["content"] for t in spec["added_tokens"]]
        plain = self._alphabet()
        to_bytes = lambda s: bytes(plain[c] for c in s)
        ranks = {}
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            ranks.setdefault((to_bytes(left), to_bytes(right)), i)
        self.merges = Merges(lambda a, b: ranks.get((a, b)))
        tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in ranks}
        self.token_at: list[bytes | None] = [None]       # trie node -> token
        self.child: dict[int, int] = {}                  # node << 8 | byte -> node
        for token in tokens:
            if len(token) > 1 and self.merges.split(token) != [token]:
                continue                                 # never a result of merging
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.token_at)
                    self.token_at.append(None)
                node = self.child[key]
            self.token_at[node] = token
        self._restart()
        self.known = Memo(self._count, self.WORD_BYTES, lambda word, count: 150 + len(word))

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """Byte of each printable stand-in: printable bytes stand for themselves,
        the rest for 256 upwards."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}

    def _restart(self, state: int = 0) -> int:
        """Forget all states but the first and ``state``, whose new number is returned."""
        first = ((0, b"", 0),)
        stay = self.keys[state] if state else first
        self.keys = [first] if stay == first else [first, stay]
        self.number = {key: i for i, key in enumerate(self.keys)}
        self.step: dict[int, int] = {}     # state << 8 | byte -> next << 8 | (change + 128)
        return len(self.keys) - 1

    def _compile(self, state: int, byte: int) -> int:
        """The transition on one byte: which token ends here, and what stays open."""
        opened, ended = [], None
        for node, last, count in self.keys[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            opened.append((node, last, count))
            token = self.token_at[node]
            if ended is None and token is not None and (
                    not last or self.merges.adjacent(last, token)):
                ended = token, count + 1
        token, change = ended
        key = tuple((n, t, c - change) for n, t, c in opened) + ((0, token, 0),)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.keys)
            self.keys.append(key)
        out = self.step[state << 8 | byte] = to << 8 | (change + 128)
        return out

    def count(self, word: bytes) -> int:
        """Number of tokens of one word; those of short words are remembered."""
        return self.known[word] if len(word) <= 64 else self._count(word)

    def _count(self, word: bytes) -> int:
        state, total, step = 0, 0, self.step
        for byte in word:
            to = step.get(state << 8 | byte)
            if to is None:
                if len(self.keys) >= self.MAX_STATES:
                    state = self._restart(state)
                    step = self.step
                to = self._compile(state, byte)
            state = to >> 8
            total += (to & 255) - 128
        return total

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; strings of added tokens count as one token."""
        parts, part_bounds, specials = [], [0], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = [text]
            for special in self.specials:
                if special in text:
                    pieces = [q for p in pieces for q in p.split(special)]
            specials[i] = len(pieces) - 1
            parts += pieces
            part_bounds.append(len(parts))
        joined = chr(0).join(parts) + chr(0)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int32)
        # separators by position: a text may itself hold the joining character
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        points[ends] = SEPARATOR
        marks = word_starts(class_table()[points])
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        width[ends] = 0
        at = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
        starts = np.flatnonzero(marks)
        codes, words = distinct_segments("".join(parts).encode(),
                                         np.append(at[starts], at[-1]))
        counts = np.array([self.count(w) for w in words], np.int64)[codes]
        words_before = np.concatenate(([0], np.cumsum(marks)))   # words that start before
        first = np.concatenate(([0], ends + 1))[part_bounds]
        return sums_between(counts, words_before[first]) + specials


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Count the tokens of every whole text.

    ``vocabulary`` is the path of a byte-level BPE file, read by the driver
    (its size does not depend on the data) and broadcast. Returns the id,
    ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    Null texts count as empty: 0 bytes, 0 tokens. Null ids, repeated ids and
    repeated rows pass through row by row. An empty table gives an empty
    result. Columns other than the two named ones are not read.
    """
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = pa.int64() if rows.schema["doc_id"].dataType.simpleString() == "bigint" else None

    def count(batches):
        counter = kept(("counter", vocabulary), lambda: Counter(shared.value))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(texts):
                part = texts[a:b]
                tokens = counter.count_texts(part)
                sizes = np.array([len(t.encode()) for t in part], np.int64)
                own = ids.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.cast(id_type) if id_type else own, pa.array(sizes), pa.array(tokens),
                     pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")

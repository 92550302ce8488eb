"""Token counts that follow edits without encoding whole texts again.

Each document carries a tree over segments of its text. A segment ends where a letter is followed by
a blank and a letter, which is a pre-token boundary whatever stands around it, so the count of a text is the sum
over its segments. The tree keeps sums of characters and tokens; an edit finds its segments by the sums of
characters, encodes anew what it touches, and updates the sums above.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.byte_bpe import Vocabulary
from scoreloom.llm.common import add_columns

#: Characters of a segment, about.
SEGMENT = 1024
#: Where a text may be cut: after the letter that this finds.
_CUT = r"\p{L}(?= \p{L})"
TREE = "chars array<int>, tokens array<int>"

Edit = tuple[int, int, str]


def cut_points(text: str, find, segment: int = SEGMENT) -> list[int]:
    """Ends of the segments: the first safe cut at or after each ``segment`` characters, and the end."""
    ends, at = [], 0
    while len(text) - at > segment:
        found = find(text, at + segment - 1)
        if found is None:
            break
        at = found.end()
        ends.append(at)
    return [*ends, len(text)] if len(text) > at or not ends else ends


class SumTree:
    """Sums over the leaves in a binary tree laid out as an array; node 1 is the root."""

    def __init__(self, leaves: list[int]):
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = np.zeros(2 * self.width, np.int64)
        self.sums[self.width : self.width + len(leaves)] = leaves
        for node in range(self.width - 1, 0, -1):
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def set(self, leaf: int, value: int) -> None:
        node = self.width + leaf
        change = value - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds the position, and where the leaf begins."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if position - before >= self.sums[node]:
                before += int(self.sums[node])
                node += 1
        return node - self.width, before


def _counter(vocabulary: Vocabulary) -> Callable[[list[str]], list[int]]:
    encode = vocabulary.encoding().encode_ordinary
    return lambda texts: [len(encode(t)) for t in texts]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """``docs`` with the leaves of its trees: ``chars`` and ``tokens`` per segment.

    The count of a text is the sum of ``tokens``. A null text has null leaves, an empty one a segment of
    nothing. Repeated rows are counted one by one; columns named like the leaves are replaced.
    """

    def make():
        import regex

        find, count = regex.compile(_CUT).search, _counter(vocabulary)

        def work(batch):
            chars, tokens = [], []
            for value in batch.column(text).to_pylist():
                if value is None:
                    chars.append(None)
                    tokens.append(None)
                    continue
                ends = cut_points(value, find, segment)
                starts = [0, *ends[:-1]]
                chars.append([e - s for s, e in zip(starts, ends, strict=True)])
                tokens.append(count([value[s:e] for s, e in zip(starts, ends, strict=True)]))
            return [pa.array(chars, pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))]

        return work

    return add_columns(docs.drop("chars", "tokens"), make, TREE)


def merged(edits: list[Edit], length: int) -> list[Edit]:
    """Edits in order, held inside the text; of overlapping ones the first (leftmost, then longest) counts."""
    kept: list[Edit] = []
    for start, end, new in sorted(edits, key=lambda e: (e[0], -e[1], e[2])):
        start, end = max(0, min(start, length)), max(0, min(end, length))
        if end >= start and (not kept or start >= kept[-1][1]) and (not kept or (start, end) != kept[-1][:2]):
            kept.append((start, end, new))
    return kept


def _seam(left: str, right: str) -> bool:
    """Whether a text may be cut between the two: a letter, then a blank and a letter."""
    return left[-1:].isalpha() and right[:1] == " " and right[1:2].isalpha()


def edited(value: str, chars: list[int], tokens: list[int], edits: list[Edit], count) -> tuple[str, list[int], list[int], int]:
    """The new text and leaves, and how many characters were encoded for them.

    Leaves that one edit touches form a region; regions that share a leaf are one. A region takes in its neighbour where the
    seam between them is no safe cut any more. It becomes its first leaf, and the others get empty.
    """
    by_chars, by_tokens = SumTree(chars), SumTree(tokens)
    if by_chars.total != len(value):
        raise ValueError("the tree belongs to another text")
    starts, last_leaf = [0, *np.cumsum(chars).tolist()], len(chars) - 1
    regions: list[list] = []  # first leaf, last leaf, edits
    for edit in merged(edits, len(value)):
        first = min(by_chars.leaf_at(edit[0])[0], last_leaf)
        last = min(by_chars.leaf_at(max(edit[0], edit[1] - 1))[0], last_leaf)
        if regions and first <= regions[-1][1]:
            regions[-1][1] = max(last, regions[-1][1])
            regions[-1][2].append(edit)
        else:
            regions.append([first, last, [edit]])
    parts: list[tuple] = []  # first leaf, last leaf, text, whether it changed

    def add(first: int, last: int, text: str, changed: bool) -> None:
        while parts and (changed or parts[-1][3]) and not _seam(parts[-1][2], text):
            before = parts.pop()
            first, text, changed = before[0], before[2] + text, True
        parts.append((first, last, text, changed))

    leaf = 0
    for first, last, own in [*regions, [len(chars), len(chars), []]]:
        for i in range(leaf, first):
            if chars[i]:
                add(i, i, value[starts[i] : starts[i + 1]], False)
        if own:
            text, place = [], starts[first]
            for start, end, new in own:
                text += [value[place:start], new]
                place = end
            add(first, last, "".join(text) + value[place : starts[last + 1]], True)
        leaf = last + 1
    redone = [p for p in parts if p[3]]
    for (first, last, text, _), n in zip(redone, count([p[2] for p in redone]), strict=True):
        for i in range(first, last + 1):
            by_chars.set(i, len(text) if i == first else 0)
            by_tokens.set(i, n if i == first else 0)
    leaves = slice(by_chars.width, by_chars.width + len(chars))
    text = "".join(p[2] for p in parts)
    return text, by_chars.sums[leaves].tolist(), by_tokens.sums[leaves].tolist(), sum(len(p[2]) for p in redone)


def apply_edits(counted: DataFrame, vocabulary: Vocabulary, edits: str = "edits", text: str = "text") -> DataFrame:
    """Rows of ``count_tokens`` after their edits, with ``encoded_chars``, the characters encoded for them.

    ``edits`` is an array of ``(start, end, new)``: characters from start up to end are replaced. Text and leaves are
    those after the edits; the column of edits goes. Places beyond the text are moved to its end, of
    overlapping edits the leftmost (then longest) counts, null edits and edits with a null part count for nothing. A null
    text stays null.
    """

    def make():
        count = _counter(vocabulary)

        def work(batch):
            out: list[list] = [[], [], [], []]
            columns = (batch.column(c).to_pylist() for c in (text, "chars", "tokens", edits))
            for value, chars, tokens, own in zip(*columns, strict=True):
                if value is None:
                    row = (None, None, None, 0)
                else:
                    own = [(e["start"], e["end"], e["new"]) for e in own or [] if e and None not in e.values()]
                    row = edited(value, chars, tokens, own, count)
                for column, item in zip(out, row, strict=True):
                    column.append(item)
            ints = pa.list_(pa.int32())
            return [pa.array(c, t) for c, t in zip(out, (pa.string(), ints, ints, pa.int64()), strict=True)]

        return work

    rows = counted.drop("encoded_chars")
    return add_columns(rows, make, f"`{text}` string, {TREE}, encoded_chars bigint", drop=(text, "chars", "tokens", edits))

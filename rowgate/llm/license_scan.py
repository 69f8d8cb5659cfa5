"""License scans by conditional compression.

A text is a stream of words (letters and digits), so that line ends, several blanks
and comment marks between words count for nothing.  Candidate blocks are the
surroundings of trigger words.  The words of a block are compressed
by themselves and with every template as a raw zstandard dictionary, and templates
are ranked by the bytes that they save.  In that order they are confirmed by exact
wording: the template's words are aligned with the block's, the words
missing and the words inserted are listed, and a notice counts if few words
differ and none of them is one that tells licences apart.  The first one confirmed is
the winner; its words are masked, and what is left of the block is compressed anew,
until no template that saves ``LEAST_SAVED`` bytes is confirmed.  So of two wordings
that fit at a place, the one that explains more of the block wins, and the second of
two notices that share words shows once the first is gone.

Every text is scanned whole, in one pass without a shuffle; the templates are
fixed values.  Blocks are bounded: a run of triggers is cut into blocks that
overlap, so each trigger is seen with more words on both sides than the longest
template has.  What blocks confirm is weighed together, so that a notice which one
block holds in part is found whole by the next.

Defined cases: a null or empty text has no block and no licence; a very long text has
blocks wherever its triggers are; every input row gives one result row, repeated rows
and rows without an id too; the columns read are picked by name, whatever further
columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

from pyspark.sql import DataFrame, SparkSession

from rowgate.llm.common import map_rows, table
from rowgate.llm.license_templates import TEMPLATES, TRIGGERS

#: Compression level: the search must find short matches.
LEVEL = 15
#: Bytes that a template must save of a block to be tried.
LEAST_SAVED = 1
#: Words that are taken by a notice; no template holds them.
_MASK = "\0"
#: Largest share of a template's words that may be missing, or inserted among them.
MAX_DIFFERENT = 0.4
_WORD = re.compile(r"[a-z0-9]+")


#: Words before and after a trigger that belong to its block: the longest template
#: with all the words that may be inserted in it.
REACH = math.ceil((1 + MAX_DIFFERENT) * max(len(_WORD.findall(t[2].lower())) for t in TEMPLATES))
#: Words between the first and the last trigger of a block.
SPAN = 250
#: Triggers by their first words, with anything but words between theirs.
_TRIGGERS = [(t.split()[0], re.compile("[^a-z0-9]++".join(t.split()))) for t in TRIGGERS]


def lowered(text: str) -> str:
    """A text in small letters, each at its old place."""
    low = text.lower()
    if len(low) != len(text):  # some capitals have longer small letters
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def candidate_blocks(low: str) -> tuple[array, array, list[tuple[int, int]]]:
    """Where the words of a text start and end, and the spans of words that may hold
    a notice (no words if there is no trigger)."""
    found: list[int] = []
    for word, trigger in _TRIGGERS:
        at = low.find(word)
        while at >= 0:
            if trigger.match(low, at):
                found.append(at)
            at = low.find(word, at + 1)
    starts, ends = array("q"), array("q")
    out: list[tuple[int, int]] = []
    if not found:
        return starts, ends, out
    for m in _WORD.finditer(low):
        starts.append(m.start())
        ends.append(m.end())
    first = last = None
    for at in sorted(found):
        k = bisect_right(starts, at) - 1
        if first is not None and k - last <= REACH and k - first <= SPAN:
            last = k
            continue
        if first is not None:
            out.append((max(0, first - REACH), min(len(starts), last + 1 + REACH)))
        first = last = k
    out.append((max(0, first - REACH), min(len(starts), last + 1 + REACH)))
    return starts, ends, out


class Scanner:
    """Compressors of all templates; one a task."""

    def __init__(self, templates: list[tuple[str, str, str]] = TEMPLATES) -> None:
        import zstandard as z

        options = dict(level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
        self.plain = z.ZstdCompressor(**options)
        self.templates = []
        for name, marks, wording in templates:
            own = _WORD.findall(wording.lower())
            raw = " ".join(own).encode()
            given = z.ZstdCompressionDict(raw * (1 + 16 // len(raw)), dict_type=z.DICT_TYPE_RAWCONTENT)
            self.templates.append((name, set(marks.split()), own, z.ZstdCompressor(dict_data=given, **options), len(self.plain.compress(raw))))
        #: Words that tell licences apart.
        self.marks = set().union(*(t[1] for t in self.templates)) - {"all", "use", "copy", "source", "free", "public", "general"}

    def reductions(self, words: list[str]) -> list[int]:
        """Bytes that every template saves of a block."""
        raw = " ".join(words).encode()
        alone = len(self.plain.compress(raw))
        return [alone - len(t[3].compress(raw)) for t in self.templates]

    def winners(self, words: list[str]) -> Iterator[tuple[int, int, int, int, list[str], list[str]]]:
        """Notices of a block: bytes saved, template, first and end word, words missing
        and inserted.  Every round has one winner and masks its words."""
        while True:
            saved = self.reductions(words)
            held = set(words)
            ranked = sorted(range(len(saved)), key=lambda i: (-saved[i], -len(self.templates[i][2]), i))
            won = None
            for i in ranked:
                if saved[i] < LEAST_SAVED:
                    break
                if not self.templates[i][1] <= held:
                    continue
                fits = [f for f in self.placements(words, i) if self.confirmed(f[2], f[3], i)]
                if fits:
                    won = (saved[i], i, *min(fits, key=lambda f: (len(f[2]) + len(f[3]), f[0])))
                    break
            if won is None:
                return
            yield won
            words[won[2]:won[3]] = [_MASK] * (won[3] - won[2])

    def placements(self, words: list[str], i: int) -> Iterator[tuple[int, int, list[str], list[str]]]:
        """Where a template may stand among a block's words, with the words that
        are missing and inserted there."""
        _, marks, own, _, _ = self.templates[i]
        rare = min(marks, key=words.count)
        at, loose = own.index(rare), len(own) // 4
        for place in [k for k, w in enumerate(words) if w == rare]:
            low = max(0, place - at - loose)
            window = words[low:place + len(own) - at + loose]
            matches = [m for m in SequenceMatcher(None, own, window, autojunk=False).get_matching_blocks() if m.size]
            a, b = low + matches[0].b, low + matches[-1].b + matches[-1].size
            inside = {low + k for m in matches for k in range(m.b, m.b + m.size)}
            missing = list(own)
            for m in matches:
                for w in own[m.a:m.a + m.size]:
                    missing.remove(w)
            yield a, b, missing, [words[k] for k in range(a, b) if k not in inside]

    def confirmed(self, missing: list[str], inserted: list[str], i: int) -> bool:
        _, marks, own, _, _ = self.templates[i]
        most = MAX_DIFFERENT * len(own)
        return (len(missing) <= most and len(inserted) <= most and not marks & set(missing)
                and not (self.marks - marks) & set(inserted) and not any(w.isdigit() for w in inserted))

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """The number of candidate blocks, and the notices confirmed in them."""
        low = lowered(text or "")
        starts, ends, blocks = candidate_blocks(low)
        found = []
        for a, b in blocks:
            words = [low[x:y] for x, y in zip(starts[a:b], ends[a:b])]
            for saved, i, first, end, missing, inserted in self.winners(words):
                found.append((len(missing) + len(inserted), -len(self.templates[i][2]), -saved, i, a + first, a + end, missing, inserted))
        # blocks overlap: of what they say of a place, the best
        taken: set[int] = set()
        hits: list[dict] = []
        for _, _, saved, i, first, end, missing, inserted in sorted(found):
            if not taken.isdisjoint(range(first, end)):
                continue
            taken.update(range(first, end))
            hits.append({"license": self.templates[i][0], "start": starts[first], "end": ends[end - 1], "reduction": -saved / self.templates[i][4],
                         "missing": missing, "inserted": inserted})
        return len(blocks), sorted(hits, key=lambda h: h["start"])


def _scan():
    scanner = Scanner()

    def run(rows: dict[str, list]) -> dict[str, list]:
        found = [scanner.scan(t) for t in rows["text"]]
        return {"doc_id": rows["doc_id"], "n_blocks": [n for n, _ in found], "n_notices": [len(h) for _, h in found],
                "licenses": [",".join(sorted({x["license"] for x in h})) for _, h in found], "notices": [h for _, h in found]}

    return run


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id, n_blocks, n_notices, licenses, notices`` for every row of ``docs``."""
    return map_rows(docs.select("doc_id", "text"), _scan,
                    "doc_id long, n_blocks int, n_notices int, licenses string, notices array<struct<license: string, start: int, end: int, "
                    "reduction: double, missing: array<string>, inserted: array<string>>>")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))

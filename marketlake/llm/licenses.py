"""License scans by conditional compression.

A candidate block (the words around a licence cue, as many on either side as
the longest template with its edits has, across line ends) is compressed by
itself and with every template as raw zstandard dictionary; a template's rank
is the size that it saves.  Templates are confirmed in that order by the exact
differences in wording: each separate span within the differences allowed is
reported with them and with the share of its own size that it saves.  A span
goes to the first template that explains it.  Confirming ends with the last
template that shares enough word pairs to match, whatever it saves, so that a
low rank loses nothing.
"""

from __future__ import annotations

import difflib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, ship_package, table, text_or_empty
from .license_texts import NAME_WORDS, TEMPLATES

CUE = (r"licen[cs]e|copyright|all\W+rights\W+reserved|permission\W+(is|to)\W|redistribution\W+and\W+use|gnu\W+general"
       r"|general\W+public|creative\W+commons|cc\W+by|cc0|unencumbered")
MAX_EDIT_SHARE = 0.15   # wording differences per word of the template
LEVEL = 3               # of compression
WINDOW = 4              # longest templates in a window that is compressed at once

_CUE = re.compile(CUE, re.IGNORECASE | re.ASCII)
_WORD = re.compile(r"\w+")
_DIGIT = re.compile(r"\d")
_FURTHER = re.compile(r"\.(?!0\b)\d")     # a version goes on; ".0" is the same version
_CLOSING = re.compile(r"[.!?)\"']*")


def _plain(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


@lru_cache(2048)
def _compressor(wording: str):
    import zstandard
    raw = None
    if wording:
        raw = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_checksum=False, write_content_size=False, write_dict_id=False)


def compressed_size(data: bytes, wording: str) -> int:
    """Bytes of ``data`` compressed with a template as raw dictionary (none:
    by itself)."""
    return len(_compressor(wording).compress(data))


def by_size_saved(words: list[str], templates: tuple) -> list[int]:
    """The templates in the order of the bytes they save of ``words``, most
    first, then the shorter template.  Long runs of words are compressed in
    windows that overlap by the longest template, so that the dictionary stays
    in reach; a template counts where it saves most."""
    every, _ = _prepared(templates)
    most = reach(templates)
    saved = [0] * len(every)
    for at in range(0, max(1, len(words) - most), (WINDOW - 1) * most):
        data = " ".join(words[at:at + WINDOW * most]).encode()
        alone = compressed_size(data, "")
        saved = [max(s, alone - compressed_size(data, joined)) for s, (_, _, _, joined) in zip(saved, every)]
    return sorted(range(len(every)), key=lambda i: (-saved[i], len(every[i][1]), i))


@lru_cache(8)
def _prepared(templates: tuple):
    """(name, words, word pairs a match has at least, joined words) of each
    template, and the templates that hold a word pair."""
    out, holders = [], {}
    for i, (name, text) in enumerate(templates):
        words = _plain(text).split()
        pairs = set(zip(words, words[1:]))
        for pair in pairs:
            holders.setdefault(pair, []).append(i)
        out.append((name, words, len(pairs) - 2 * int(MAX_EDIT_SHARE * len(words)), " ".join(words)))
    return out, holders


def _same_name(wording: list[str], near: list[str]) -> bool:
    """Whether the words that tell a licence from its siblings are equal."""
    digits = any(_DIGIT.search(w) for w in wording)

    def telling(words):
        return [w for w in words if w in NAME_WORDS or digits and _DIGIT.search(w)]
    return telling(wording) == telling(near)


def blocks(text: str, around: int) -> list[tuple[int, int]]:
    """Candidate blocks (start, end): ``around`` words on either side of each
    cue, across line ends; touching ones are one."""
    cues = [m.span() for m in _CUE.finditer(text)]
    if not cues:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    starts, ends = [a for a, _ in places], [z for _, z in places]
    out: list[tuple[int, int]] = []
    for a, z in cues:
        first = max(0, bisect_right(ends, a) - around)
        last = min(len(places), bisect_left(starts, z) + around)
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return [(starts[a], len(text) if z == len(places) else starts[z]) for a, z in out]


@lru_cache(8)
def reach(templates: tuple) -> int:
    """Words of the longest template with its edits."""
    return max(int(len(_plain(t).split()) * (1 + MAX_EDIT_SHARE)) for _, t in templates)


def _scores(item: list[int], text: list[int], anchored: bool = False) -> Iterator[int]:
    """Edit distance of ``item`` to the best run of ``text`` that ends after
    each word (``anchored``: to the run from the first word on), by Myers's
    bit-parallel search."""
    m = len(item)
    mask, top, at = (1 << m) - 1, 1 << (m - 1), {}
    for i, c in enumerate(item):
        at[c] = at.get(c, 0) | (1 << i)
    pv, mv, score, first = mask, 0, m, int(anchored)
    for c in text:
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = (mv | ~(xh | pv)) & mask, pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1 | first) & mask, (mh << 1) & mask
        pv, mv = (mh | ~(xv | ph)) & mask, ph & xv
        yield score


def _spans(wording: list[str], words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(first word, word after the last, wording differences) of each separate
    run of ``words`` within the differences allowed; neighbouring ends are one
    run, which ends where the differences are fewest."""
    number = {w: i for i, w in enumerate(dict.fromkeys(wording))}
    item, text = [number[w] for w in wording], [number.get(w, -1) for w in words]
    most = int(MAX_EDIT_SHARE * len(wording))
    best = None
    for end, edits in enumerate([*_scores(item, text), most + 1], 1):
        if edits <= most:
            best = min(best or (edits, end), (edits, end))
        elif best:
            edits, end = best
            back = text[max(0, end - len(item) - most):end][::-1]
            back = enumerate(_scores(item[::-1], back, True), 1)
            n = min(back, key=lambda x: (x[1], abs(x[0] - len(item))))[0]
            yield end - n, end, edits
            best = None


def explain(block: str, templates: tuple = TEMPLATES) -> list[tuple[int, int, str, float, int, str]]:
    """(start, end, licence, share of the span's size saved, wording
    differences, what differs) of each separate span of the block that a
    template explains, spans of the templates that save most first.  A template
    that shares too few word pairs with the block is passed over: a difference
    spoils at most two, so it cannot match.  A span that differs in words of
    the name or version, or whose version goes on, is none."""
    every, holders = _prepared(templates)
    places = [m.span() for m in _WORD.finditer(block)]
    words = [block[a:z].lower() for a, z in places]
    shared = Counter(i for pair in set(zip(words, words[1:])) for i in holders.get(pair, ()))
    if not any(n >= every[i][2] for i, n in shared.items()):
        return []
    out, taken = [], bytearray(len(words))
    for i in by_size_saved(words, templates):
        name, wording, need, joined = every[i]
        for a, z, edits in sorted(_spans(wording, words), key=lambda x: (x[2], x[0])) if shared[i] >= need else ():
            further = _DIGIT.search(wording[-1]) and _FURTHER.match(block, places[z - 1][1])
            if further or any(taken[a:z]) or edits and not _same_name(wording, words[a:z]):
                continue
            taken[a:z] = b"\1" * (z - a)
            data = " ".join(words[a:z]).encode()
            saved = 1 - compressed_size(data, joined) / compressed_size(data, "")
            start, end = places[a][0], _CLOSING.match(block, places[z - 1][1]).end()
            out.append((start, end, name, saved, edits, _differences(wording, words[a:z]) if edits else ""))
    return sorted(out)


def _differences(wording: list[str], near: list[str]) -> str:
    """``-`` words of the template that are missing, ``+`` words put in."""
    out = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, wording, near, False).get_opcodes():
        if op != "equal":
            out += [f"-{w}" for w in wording[a:b]] + [f"+{w}" for w in near[c:d]]
    return " ".join(out)


_FOUND = "doc_id long, license string, start int, `end` int, saved double, differing_words int, differences string"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per separate span that a template explains: doc_id, license,
    start, end (code points), saved, differing_words, differences.  Null and
    empty texts have none; repeated rows are reported each; a null id comes
    back as null; an empty table has no rows; texts of any length are searched
    around their cues; of templates that save the same the shorter, then the
    earlier, is confirmed first; other columns are ignored, whatever their
    names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for a, z in blocks(text, reach(templates)):
                    for start, end, *hit in explain(text[a:z], templates):
                        out.append((doc, hit[0], a + start, a + end, *hit[1:]))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                                             names=["doc_id", "license", "start", "end", "saved", "differing_words", "differences"])
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).cast("long"), text).where(text.rlike(f"(?i){CUE}")).mapInArrow(run, _FOUND)


@query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return scan(table(spark, sf_dir, "documents"))

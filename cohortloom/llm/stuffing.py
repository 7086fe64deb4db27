"""Keyword-stuffed and link-list pages by line shapes.

A page is cut into lines, and lines into sentences, separated fields and, where nothing separates, runs of words. Each
piece is reduced to its shape: links, separator, bucket of the word count, capitals, digits, end mark, and whether it
says the same few words again. No word list takes part. A shape is either that of a sentence (a capital or a figure at the
start, enough different words, an end mark), that of a record (log line, sample sheet, key and value, gene list,
reference), or neither. Pieces are grouped by their shape, and a page is spam if a few shapes that are neither hold most
of its words. A page is judged alone, so the pass is narrow at any size.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import spread

_TAG_LINK = re.compile(r"<a\b[^>]*>(.*?)(?:</a\s*>|$)|!?\[([^\]\n]*)\]\(([^)\s]*)\)", re.I | re.S)
_URL = re.compile(r"(?:https?://|www\.)[^\s<>\"'|)\],;]+", re.I)
_BREAK = re.compile(r"<\s*/?\s*(?:br|p|div|li|ul|ol|tr|td|th|h[1-6])\b[^>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>\n]*>")
_HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_WORD = re.compile(r"[^\W_]+(?:[-.'’][^\W_]+)*")
_BULLET = re.compile(r"^\s*(?:[-*•·>]+|\d{1,3}[.)])\s+")
_STAMP = re.compile(r"^\W*(?:\d{4}-\d\d-\d\d[T ]?)?\d{1,2}:\d\d(?::\d\d)?\b|^\W*\d{4}-\d\d-\d\d\b")
_FIELD = re.compile(r"(?:^|[\s;,|(])([A-Za-z][\w.]*)=\S")
_KEY = re.compile(r"(?:^|[;,|\t])\s*([A-Za-z][A-Za-z _-]*?)\s*:\s*(?=\S)")
_ID = re.compile(r"[A-Z]{2,6}_?\d{4,}")
_CITED = re.compile(r"^\s*(?:\[\d{1,3}\]|\d{1,3}[.)])\s+\S")
_PAPER = re.compile(r"\bdoi\b|\bet al\b|\b(?:19|20)\d\d\s*;\s*\d|\b\d+\s*\(\d+\)\s*:\s*\d|\b\d+\s*:\s*\d+\s*[-–]\s*\d+", re.I)
_GENE = re.compile(r"[A-Z][A-Z0-9]{2,}(?:-[A-Z0-9]+)?")
_SEPARATOR = re.compile(r"\s*(?:[;,|•·\t]|\s[-–—~/>»*]+\s|\s#)\s*")
_END = re.compile(r"[.!?…:][\"”’)\]*`]*\s*$")


def lines(text: str) -> list[tuple[str, int]]:
    """(text of a line without markup, number of links in it)."""
    t = _HIDDEN.sub("", html.unescape(text))
    t = _TAG_LINK.sub(lambda m: f" \x00{(m[1] or m[2] or '')} \x01 ", t)
    t = _TAG.sub(" ", _BREAK.sub("\n", t))
    out: list[tuple[str, int]] = []
    for line in t.splitlines():
        n = line.count("\x01") + len(_URL.findall(line))
        body = line.strip()
        if not body:
            continue
        # a sentence that is wrapped goes on in lower case
        if out and not n and not out[-1][1] and body[0].islower() and not _KEY.match(body) and not _END.search(out[-1][0]) and min(len(_WORD.findall(out[-1][0])), 6) == 6:
            out[-1] = (f"{out[-1][0]} {body}", 0)
        else:
            out.append((body, n))
    return out


def _bucket(n: int) -> int:
    """Word counts to 1, 2, 4 (three or four), 8, 16, and 32 for all above."""
    return next((b for b in (1, 2, 4, 8, 16) if n <= b), 32)


def _capitals(piece: str) -> str:
    if piece.isupper():
        return "upper"
    first = next((c for c in piece if c.isalpha()), "")
    return "first" if first.isupper() else "lower" if first else "none"


def repeats(words: list[str]) -> bool:
    """Fewer different words than a text of so many has: under two thirds of 16, under half of 40, under a third beyond 100."""
    n, k = len(words), len(set(words))
    return n >= 8 and k < n * (0.67 if n <= 16 else 0.5 if n <= 100 else 0.34)


def is_sentence(piece: str, words: list[str], cut: bool = False) -> bool:
    """Five words or more that begin with a capital, a figure or an opening mark, or eight that begin otherwise, up to an end mark, and few of them again.

    Text in capitals takes eight words too. The last piece of a page may be ``cut`` off before its end mark, and twelve
    words that nothing separates need none.
    """
    start = next((c for c in piece if c.isalnum()), "")
    lower = sum(w[:1].islower() for w in words)
    opened = (start.isupper() or start.isdigit()) and lower >= max(2, 0.3 * len(words))
    return len(words) >= (5 if opened else 8) and (cut or bool(_END.search(piece)) or len(words) >= 12 and len(_SEPARATOR.split(piece)) <= 2) and not repeats([w.lower() for w in words])


def shapes(text: str) -> list[tuple[int, str, tuple]]:
    """(number of words, kind, shape) of the pieces of a page; kind is sentence, record or bare."""
    out: list[tuple[int, str, tuple]] = []
    page = lines(text)
    keys = {k.strip().lower() for line, n in page if not n for k in _KEY.findall(_BULLET.sub("", line))}
    for line, n_links in page:
        bare = _URL.sub(" ", line)
        if n_links:
            anchors = " ".join(re.findall("\x00([^\x01]*)\x01", bare))
            around = _WORD.findall(re.sub("\x00[^\x01]*\x01", " ", bare))
            cited = n_links <= 2 and (_CITED.match(line) or _PAPER.search(bare))
            if cited or len(around) < 8 * n_links:
                # a bare address weighs as three words
                n = 3 * n_links + len(_WORD.findall(anchors)) + len(around)
                out.append((n, "record" if cited else "bare", ("link", min(n_links, 3), _bucket(len(around)))))
                continue
            # few links within prose
            bare = bare.replace("\x00", " ").replace("\x01", " ")
        body = _BULLET.sub("", bare).strip()
        words = _WORD.findall(body)
        if not words:
            continue
        cells = [c for c in re.split(r"\s*[|\t;,]\s*", body) if c]
        fields = _FIELD.findall(body)
        if _STAMP.match(body) or len(fields) >= 2:
            out.append((len(words), "record", ("log",)))
            continue
        if len(cells) >= 3 and (_ID.fullmatch(cells[0]) or _ID.fullmatch(cells[-1])):
            out.append((len(words), "record", ("sheet", min(len(cells), 8))))
            continue
        if _PAPER.search(body) or _CITED.match(bare) and len(cells) >= 3 and _END.search(body) and not repeats([w.lower() for w in words]):
            out.append((len(words), "record", ("reference",)))
            continue
        own = _KEY.findall(body)
        if own and len(keys) >= 3 and (len(own) >= 4 or (len(own) >= 2 or len(words) <= 12) and 2 * len(own) >= len(cells)):
            out.append((len(words), "record", ("key and value", min(len(own), 8))))
            continue
        pieces = re.split(r"(?<=[.!?…])\s+", body)
        for at, piece in enumerate(pieces):
            words = _WORD.findall(piece)
            if not words:
                continue
            low = [w.lower() for w in words]
            parts = [p for p in _SEPARATOR.split(piece) if _WORD.search(p)]
            sizes = [len(_WORD.findall(p)) for p in parts]
            listed = len(parts) >= 6 and sum(n <= 5 for n in sizes) >= 0.8 * len(parts)
            genes = [p for p in parts if _GENE.fullmatch(p.rpartition(":")[2].strip(" ."))]
            cut = at == len(pieces) - 1 and line is page[-1][0]
            if listed and ":" in piece and len(genes) >= 0.7 * len(parts):
                out.append((len(words), "record", ("genes",)))
            elif is_sentence(piece, words, cut) and not listed:
                out.append((len(words), "sentence", ("sentence", _bucket(len(words)))))
            elif len(parts) > 1:
                mark = next((s for s in "|;\t/»•·#,-–—~*>" if s in piece), "")
                for p, n in zip(parts, sizes):
                    out.append((n, "bare", (mark, _bucket(n), _capitals(p), any(c.isdigit() for c in p))))
            else:
                for s in range(0, len(words), 16):
                    w = low[s : s + 16]
                    end = bool(_END.search(piece))
                    out.append((len(w), "bare", ("run" if len(words) > 16 else "line", _bucket(len(w)), _capitals(piece), repeats(w), end)))
    return out


def stuffed_share(text: str | None, few: int = 8) -> tuple[float, int, float]:
    """(share of the words that the ``few`` commonest bare shapes hold, number of words, share of all bare shapes)."""
    found = shapes(text) if text else []
    total = sum(n for n, _, _ in found)
    if not total:
        return 0.0, 0, 0.0
    grouped: Counter = Counter()
    for n, kind, shape in found:
        if kind == "bare":
            grouped[shape] += n
    return sum(n for _, n in grouped.most_common(few)) / total, total, sum(grouped.values()) / total


def stuffed_pages(df: DataFrame, id_col: str, text_col: str, share: float = 0.5, few: int = 8, least_words: int = 12) -> DataFrame:
    """(id, stuffed_share, n_words, shape_dominance) of the pages at least ``share`` of whose words stand in ``few`` shapes that are neither sentences nor records.

    ``shape_dominance`` is the part of these shapes in all bare words. Null and empty texts and pages of fewer than
    ``least_words`` words give no row; repeated rows each give their own; whole texts are read.
    """
    id_type = df.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, text in zip(b["id"], b["t"]):
                held, n, bare = stuffed_share(text if isinstance(text, str) else None, few)
                if n >= least_words and held >= share:
                    out.append((key, held, n, held / bare))
            yield pd.DataFrame(out, columns=["id", "stuffed_share", "n_words", "shape_dominance"])

    rows = spread(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")))
    return rows.mapInPandas(judge, f"id {id_type}, stuffed_share double, n_words long, shape_dominance double").withColumnRenamed("id", id_col)

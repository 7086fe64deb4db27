"""Free-entered values mapped to a canonical list by BK-trees.

The answer's metric is the unrestricted Damerau-Levenshtein distance (insert, delete, substitute, swap of neighbours,
each 1). The trees are kept under the Levenshtein distance, a true metric in which a swap is 2, so a radius of twice the
threshold holds every key within the threshold, and the exact distance of the few that are left decides. Distances of many
texts to one key are taken side by side, bit-parallel, and a tree is walked by all texts of a batch together.

A value names an entry with a part of its words: every run of its words, of up to the longest key's length, is asked of
the tree. Numbers bear no edits, so keys of different numbers stand in different trees. Words that many values have and
no entry has are decoration and are also left out within a run. The list is cut into shards of bounded size by a hash of
the entry; each shard's trees go to all tasks, every distinct value is searched in every shard, and the shards' winners
are merged per value. A value that fills a third of the rows is searched once.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

# --- fixed values: adjectives of organs, for lists that don't tell them themselves ------------------------
ORGANS = {
    "cutaneous": "skin", "pulmonary": "lung", "prostatic": "prostate", "pancreatic": "pancreas", "gastric": "stomach", "esophageal": "esophagus", "laryngeal": "larynx",
    "renal": "kidney", "cervical": "uterine cervix", "colorectal": "colorectum", "cerebral": "brain", "hepatic": "liver", "ovarian": "ovary", "mammary": "breast",
    "thyroid": "thyroid gland", "conjunctival": "conjunctiva", "vesical": "bladder", "splenic": "spleen",
}
# --------------------------------------------------------------------------------------------------------
_ONE = np.uint64(1)


def edit_distance(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance."""
    if a == b:
        return 0
    n, m = len(a), len(b)
    if not n or not m:
        return n + m
    far = n + m
    rows = [[far] * (m + 2), [far, *range(m + 1)]]
    last_row: dict[str, int] = {}
    for i in range(1, n + 1):
        x = a[i - 1]
        prev = rows[i]
        row = [far, i]
        match_col = 0
        left = i
        for j in range(1, m + 1):
            y = b[j - 1]
            r = last_row.get(y, 0)
            if x == y:
                d = prev[j]
                s = rows[r][match_col] + i - r - 1 + j - match_col
                if s < d:
                    d = s
                col = match_col
                match_col = j
            else:
                d = prev[j] + 1
                if left + 1 < d:
                    d = left + 1
                if prev[j + 1] + 1 < d:
                    d = prev[j + 1] + 1
                if r and match_col:
                    s = rows[r][match_col] + i - r + j - match_col - 1
                    if s < d:
                        d = s
            row.append(d)
            left = d
        rows.append(row)
        last_row[x] = i
    return rows[-1][-1]


class Key:
    """A key with the places of its characters as bits, for Myers' bit-parallel Levenshtein distance."""

    def __init__(self, text: str) -> None:
        self.text, self.bits = text, defaultdict(int)
        for i, c in enumerate(text):
            self.bits[c] |= 1 << i
        self.letters = np.array(sorted(map(ord, self.bits)), dtype="uint32")

    def distance(self, text: str) -> int:
        if not self.text:
            return len(text)
        score, top, full = len(self.text), 1 << (len(self.text) - 1), (1 << len(self.text)) - 1
        plus, minus, get = full, 0, self.bits.get
        for c in text:
            eq = get(c, 0)
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph, mh = minus | (full & ~(xh | plus)), plus & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = (ph << 1) | 1
            plus, minus = (mh << 1 | ~(xv | ph)) & full, ph & xv & full
        return score


class Texts:
    """Texts as rows of character codes, to be compared with one key at a time."""

    def __init__(self, texts: list[str]) -> None:
        self.texts, self.sizes = texts, np.array([len(t) for t in texts], dtype="int64")
        self.codes = np.zeros((int(self.sizes.max(initial=0)), len(texts)), dtype="uint32")
        for i, t in enumerate(texts):
            self.codes[: len(t), i] = np.frombuffer(t.encode("utf-32-le"), dtype="uint32")

    def distances(self, key: Key, rows: np.ndarray) -> np.ndarray:
        """Levenshtein distances of the texts ``rows`` to ``key``; many texts go a character a step, side by side, if the key has no more than 64."""
        if len(rows) < 40 or not 0 < len(key.text) <= 64:
            return np.array([key.distance(self.texts[i]) for i in rows.tolist()], dtype="int64")
        order = np.argsort(-self.sizes[rows], kind="stable")
        sizes = self.sizes[rows[order]]
        codes = self.codes[: int(sizes[0]), rows[order]]
        place = np.minimum(np.searchsorted(key.letters, codes), len(key.letters) - 1)
        masks = np.array([key.bits[chr(x)] for x in key.letters.tolist()], dtype="uint64")
        matches = np.where(key.letters[place] == codes, masks[place], np.uint64(0))
        score = np.full(len(rows), len(key.text), dtype="int64")
        plus, minus, top = np.full(len(rows), ~np.uint64(0)), np.zeros(len(rows), dtype="uint64"), np.uint64(len(key.text) - 1)
        # longest texts first: those that are still read are a prefix
        for j, n in enumerate(np.searchsorted(-sizes, -np.arange(len(codes)), side="left").tolist()):
            eq, plus, minus = matches[j, :n], plus[:n], minus[:n]
            xv = eq | minus
            xh = (((eq & plus) + plus) ^ plus) | eq
            ph, mh = minus | ~(xh | plus), plus & xh
            score[:n] += ((ph >> top) & _ONE).view("int64") - ((mh >> top) & _ONE).view("int64")
            ph = (ph << _ONE) | _ONE
            plus, minus = (mh << _ONE) | ~(xv | ph), ph & xv
        out = np.empty(len(rows), dtype="int64")
        out[order] = score
        return out


class BKTree:
    """Keys in a tree under the Levenshtein distance; a search returns every key within a threshold of ``edit_distance``."""

    def __init__(self, keys: Iterable[str] = ()) -> None:
        self.nodes: list[tuple[Key, dict[int, int]]] = []
        every = list(dict.fromkeys(keys))
        self.span = (min(map(len, every), default=0), max(map(len, every), default=0))
        if every:
            self._grow(Texts(every))

    def _grow(self, keys: Texts) -> None:
        """Sets of keys become subtrees: the first is their root, the others go below it by their distance."""
        todo: list[tuple[np.ndarray, int | None, int]] = [(np.arange(len(keys.texts)), None, 0)]
        while todo:
            rows, parent, edge = todo.pop()
            if parent is not None:
                self.nodes[parent][1][edge] = len(self.nodes)
            root = Key(keys.texts[rows[0]])
            self.nodes.append((root, {}))
            here, rest = len(self.nodes) - 1, rows[1:]
            if len(rest):
                d = keys.distances(root, rest)
                todo += [(rest[d == x], here, x) for x in np.unique(d).tolist()]

    def search_all(self, texts: list[str], thresholds: list[int]) -> dict[int, list[tuple[int, str]]]:
        """By position of the text, the (distance, key) within its threshold; all texts go down the tree together."""
        out: dict[int, list[tuple[int, str]]] = defaultdict(list)
        if not self.nodes or not texts:
            return out
        asked, limit = Texts(texts), np.array(thresholds, dtype="int64")
        # no key is nearer than the difference of the lengths
        todo = [(0, np.flatnonzero((asked.sizes + limit >= self.span[0]) & (asked.sizes - limit <= self.span[1])))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            key, children = self.nodes[at]
            d, radius = asked.distances(key, rows), 2 * limit[rows]
            for i in rows[d <= radius].tolist():
                exact = edit_distance(texts[i], key.text)
                if exact <= limit[i]:
                    out[i].append((exact, key.text))
            for edge, child in children.items():
                near = np.abs(d - edge) <= radius
                if near.any():
                    todo.append((child, rows[near]))
        return out

    def search(self, text: str, threshold: int) -> list[tuple[int, str]]:
        return sorted(self.search_all([text], [threshold]).get(0, []))


def tokens(text: str) -> list[str]:
    """Words and numbers in lower case; letters and digits are set apart."""
    t = unicodedata.normalize("NFKC", text).lower()
    return re.findall(r"[^\W\d_]+|\d+", t)


def singular(word: str) -> str:
    return word[:-1] if len(word) > 4 and word[-1] == "s" and word[-2] not in "sui" else word


def plain(text: str) -> str:
    return " ".join(x for x in tokens(text) if x not in ("of", "the"))


def entry_keys(ref_id: str, preferred: str | None, synonyms: str | None, organs: dict[str, str]) -> set[str]:
    """All spellings under which an entry is indexed: id, name, synonyms, and for ``organ kind`` names the turned forms."""
    names = [x for x in [preferred, *(synonyms or "").split("|")] if x and x.strip()]
    keys = {plain(x) for x in names} | {plain(ref_id)}
    words = tokens(preferred or "")
    if len(words) == 2 and words[0] in organs:
        noun = [w for w in organs[words[0]].split() if w not in ("of", "the")]
        for n in {" ".join(noun), noun[0], noun[-1]} if noun[-1] == "gland" else {" ".join(noun), noun[-1]}:
            keys |= {f"{words[1]} {n}", f"{n} {words[1]}"}
        keys.add(f"{words[1]} {words[0]}")
    return {k for k in keys if k}


def entry_words(rows: list[tuple]) -> set[str]:
    """All words of the entries (ref_id, vocab, preferred name, synonyms), as typed and in the singular."""
    words = {w for r in rows for x in (r[0], *r[2:4]) for w in tokens(x or "")}
    return words | {singular(w) for w in words}


def _allowed(key: str) -> int:
    """Edits that a key of its length can bear: codes and short words none, others up to two."""
    letters = sum(c.isalpha() for c in key)
    return 0 if letters <= 4 else 1 if letters <= 5 else 2


def numbers(text: str) -> str:
    return " ".join(re.findall(r"\d+", text))


def readings(value: str, decoration: frozenset[str], longest: int) -> set[str]:
    """Every run of up to ``longest`` words of the value, with and without plural endings and decoration.

    A number behind a run belongs to the name, so a run of words doesn't end before one.
    """
    words = [w for w in tokens(value.replace("_", " ")) if w not in ("of", "the")]
    out: set[str] = set()
    for ws in (words, [w for w in words if w not in decoration]):
        for row in (ws, [singular(w) for w in ws]):
            for i in range(len(row)):
                for j in range(i + 1, min(len(row), i + longest) + 1):
                    if j == len(row) or not row[j].isdigit() or row[j - 1].isdigit():
                        out.add(" ".join(row[i:j]))
    return out


class Index:
    """One shard of the list: the entries behind each key, and a BK-tree of the keys of each vocabulary and number."""

    def __init__(self, rows: list[tuple[str, str, str | None, str | None]], organs: dict[str, str], decoration: frozenset[str] = frozenset()) -> None:
        self.refs: dict[str, dict[str, set[str]]] = {}
        self.decoration = decoration
        for ref_id, vocab, preferred, synonyms in rows:
            for key in entry_keys(ref_id, preferred, synonyms, organs):
                self.refs.setdefault(vocab, {}).setdefault(key, set()).add(ref_id)
        keys: dict[tuple[str, str], list[str]] = defaultdict(list)
        for vocab, of in self.refs.items():
            for key in sorted(of):
                keys[vocab, numbers(key)].append(key)
        self.trees = {k: BKTree(v) for k, v in keys.items()}
        # a typed blank may cut a word in two
        self.longest = {v: max(len(k.split()) for k in of) + 1 for v, of in self.refs.items()}

    def best_of(self, asked: list[tuple[str, str]]) -> list[tuple[int, int, str, str] | None]:
        """(distance, -length of the key, ref_id, key) of the best entry of each (vocab, value), or None.

        The best covers most letters, an edit counting as three that aren't covered; then the smaller ref_id.
        """
        by_tree: dict[tuple[str, str], dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        for i, (vocab, value) in enumerate(asked):
            if vocab in self.refs:
                for r in readings(value, self.decoration, self.longest[vocab]):
                    if (vocab, numbers(r)) in self.trees:
                        by_tree[vocab, numbers(r)][r].append(i)
        found: dict[int, tuple] = {}
        for (vocab, number), owners in by_tree.items():
            texts = list(owners)
            for t, hits in self.trees[vocab, number].search_all(texts, [_allowed(x) for x in texts]).items():
                for d, key in hits:
                    # the key must bear the edits too
                    if d <= _allowed(key):
                        rank = min((3 * d - len(key), d, -len(key), r, key) for r in self.refs[vocab][key])
                        for i in owners[texts[t]]:
                            if i not in found or rank < found[i]:
                                found[i] = rank
        return [found[i][1:] if i in found else None for i in range(len(asked))]

    def best(self, vocab: str, value: str) -> tuple[int, int, str, str] | None:
        return self.best_of([(vocab, value)])[0]


_built: dict[str, Index] = {}


def map_values(values: DataFrame, reference: DataFrame, shard_rows: int = 20_000, decoration_share: float = 0.002) -> DataFrame:
    """The best entry for each distinct (vocab, value) of ``values``: vocab, value, n_rows, ref_id, distance, key.

    ``reference`` has ref_id, vocab, preferred_name, synonyms. Values within no entry's threshold have null
    ref_id; null values give no row; blank values are unmatched; of several entries the one that covers most of the value
    wins, then the smaller ref_id. At most ``shard_rows`` entries are sent to the tasks at once, one shard after the other. Words of at least
    ``decoration_share`` of the distinct values that no entry has are decoration.
    """
    spark = values.sparkSession
    ref = reference.filter(F.col("ref_id").isNotNull()).select("ref_id", "vocab", "preferred_name", "synonyms")
    total = ref.count()
    shards = max(1, -(-total // shard_rows) * (2 if total > shard_rows else 1))
    pairs = ref.select("preferred_name", F.explode(F.split("synonyms", r"\|")).alias("synonym")).select(
        F.lower(F.regexp_extract("preferred_name", r"^(\S+) \S+$", 1)).alias("adjective"),
        F.lower(F.regexp_extract("preferred_name", r"^\S+ (\S+)$", 1)).alias("kind"),
        F.regexp_extract(F.lower(F.trim("synonym")), r"^(\S+) of (?:the )?.+$", 1).alias("same"),
        F.regexp_extract(F.lower(F.trim("synonym")), r"^\S+ of (?:the )?(.+)$", 1).alias("noun"),
    )
    learned = pairs.filter("adjective <> '' and noun <> '' and kind = same").groupBy("adjective").agg(F.min("noun").alias("noun"))
    if shards > 1:
        learned = materialize(learned, "organs")
    distinct = values.filter(F.col("value").isNotNull() & F.col("vocab").isNotNull()).groupBy("vocab", "value").agg(F.count("*").alias("n_rows"))
    distinct = materialize(distinct, "distinct-values")
    least = max(20, int(distinct.count() * decoration_share))
    # at most words-per-value / decoration_share words pass
    words = distinct.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit(r"([^\W\d_]+)"), F.lit(1)))).alias("w")).groupBy("w").count().filter(F.col("count") >= least)
    frequent = {r.w for r in words.collect()}
    # the search costs much a value, so the distinct values are spread whatever their bytes
    wide = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    spread_values = distinct.repartition(wide, "value")
    schema = "vocab string, value string, n_rows long, ref_id string, distance int, key string"
    parts, results = [], []
    for s in range(shards):
        rows = [tuple(r) for r in ref.filter(F.pmod(F.xxhash64("ref_id"), F.lit(shards)) == s).collect()]
        frequent -= entry_words(rows)
        # a shard needs the organs of its own adjectives only, however many the list has
        own = {w[0] for r in rows if len(w := tokens(r[2] or "")) == 2}
        organs = dict(ORGANS)
        if own:
            organs |= {r.adjective: r.noun for r in learned.join(spark.createDataFrame([(x,) for x in sorted(own)], "adjective string"), "adjective", "left_semi").collect()}
        parts.append(spark.sparkContext.broadcast((uuid.uuid4().hex, rows, organs)))
    decoration = frozenset(frequent)
    for shipped in parts:

        def search(batches: Iterator[pd.DataFrame], shipped=shipped) -> Iterator[pd.DataFrame]:
            token, rows, organs = shipped.value
            if token not in _built:
                # one index a worker process; that of an earlier shard makes room
                _built.clear()
                _built[token] = Index(rows, organs, decoration)
            for b in batches:
                for s in range(0, len(b), 5000):
                    part = b.iloc[s : s + 5000]
                    hits = _built[token].best_of(list(zip(part["vocab"], part["value"])))
                    frame = pd.DataFrame([(h[2], h[0], h[3]) if h else (None, None, None) for h in hits], columns=["ref_id", "distance", "key"])
                    frame["distance"] = frame["distance"].astype("Int32")
                    yield pd.concat([part.reset_index(drop=True), frame], axis=1)

        results.append(spread_values.select("vocab", "value", "n_rows").mapInPandas(search, schema))
    if len(results) == 1:
        return results[0]
    every = reduce(DataFrame.unionAll, results).filter(F.col("ref_id").isNotNull())
    rank = F.struct((3 * F.col("distance") - F.length("key")).alias("o"), "distance", "ref_id", "key")
    best = every.groupBy("vocab", "value").agg(F.min(rank).alias("m")).select("vocab", "value", "m.ref_id", "m.distance", "m.key")
    return distinct.join(best, ["vocab", "value"], "left")


def map_columns(df: DataFrame, id_col: str, fields: dict[str, str], reference: DataFrame, shard_rows: int = 20_000) -> DataFrame:
    """One row per id and non-null field of ``fields`` (column to vocabulary): id, field_name, value, ref_id (null: unmatched), distance, key.

    Values that fill a 200th of the rows or more, at most 200 of them, are joined back by broadcast; the others by value.
    """
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.lit(v).alias("vocab"), F.col(c).alias("value")) for c, v in fields.items()])).alias("x")
    long = df.select(F.col(id_col), stack).select(id_col, "x.*").filter(F.col("value").isNotNull())
    mapped = materialize(map_values(long, reference, shard_rows), "mapped-values")
    least = max(1, -(-(mapped.agg(F.sum("n_rows")).first()[0] or 0) // 200))
    hot, rest = mapped.filter(F.col("n_rows") >= least).drop("n_rows"), mapped.filter(F.col("n_rows") < least).drop("n_rows")
    names = [id_col, "field_name", "value", "ref_id", "distance", "key"]
    hit = long.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), ["vocab", "value"], "left")
    found = hit.filter("_hot").select(*names)
    other = hit.filter("_hot is null").select(id_col, "field_name", "vocab", "value").join(rest, ["vocab", "value"], "left")
    return found.unionByName(other.select(*names))

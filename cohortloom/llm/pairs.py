"""Broken prompt and response pairs: empty, copied, refused, foreign-language and truncated answers.

- empty: nothing but blanks, invisible characters or a placeholder;
- copied: greedy string tiling covers most of the answer's words with the prompt's own runs of words;
- refusal: a sentence of a first-person declining grammar, and no sentence that says anything about the case;
- other_language: script and function-word profile of the answer against the prompt's;
- truncated: a pushdown parser finds fences, brackets, quotations, list items or markup left open, or the last
  sentence stops where the corpus' own sentences go on (counts of word runs over all texts tell how often a
  sentence ends there).

Each kind is looked for in the text without its quoted parts where quoting would mislead.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize, spread

# --- fixed values: function words and refusal wording ----------------------------------------------------
# articles, prepositions, pronouns, conjunctions and auxiliaries of each language
FUNCTION_WORDS = {
    "en": "the of and is in to that a an which with not for as are this it on by from but so than its both be was were has have had does do did or at would i we you he she they there while although because only what neither nor since could can will these those each no if when where who into been being our your their his her them us",
    "it": "il lo la i gli le un uno una di del dello della dei degli delle a al allo alla ai agli alle da dal dallo dalla dai dagli dalle in nel nello nella nei negli nelle con su sul sullo sulla sui sugli sulle per tra fra e ed o od ma che chi cui non si ci è sono era erano ha ho hanno aveva stato stata stati state come perché quindi anche più meno questo questa questi queste quello quella io noi lui lei loro mi ti se dopo prima mentre quando",
    "de": "der die das des dem den ein eine einer eines einem einen und oder aber denn weil dass wenn als wie ist sind war waren hat haben hatte wird werden wurde wurden nicht mit für auf von vom zu zum zur im in an am aus bei nach vor über unter zwischen durch ohne um sie er es wir ich sich auch nur noch schon sehr daher deshalb diese dieser dieses beide beim",
    "fr": "le la les l un une des du de d au aux et ou mais donc car que qui quoi dont où ce cet cette ces est sont était étaient a ont avait dans sur sous avec sans pour par entre vers chez ne pas plus moins très aussi comme parce il elle ils elles on nous vous je se son sa ses leur leurs été",
    "es": "el la los las un una unos unas de del al a en con sin por para entre sobre hasta desde y e o u pero porque que quien cual cuyo no se lo le les su sus es son era eran ha han había está están fue fueron como más menos muy también así este esta estos estas yo nosotros ellos ella si cuando donde",
    "pt": "o a os as um uma uns umas de do da dos das ao aos à às em no na nos nas com sem por para pelo pela entre sobre até e ou mas porque que quem cujo não se lhe seu sua seus suas é são era eram há tem têm foi foram está estão como mais menos muito também este esta estes estas eu nós eles ela quando onde já",
    "nl": "de het een en of maar want omdat dat die dit deze is zijn was waren heeft hebben had wordt worden werd niet met voor op van naar in uit bij door over onder tussen zonder om ik wij hij zij ze er ook nog zeer daarom dan als",
    "sv": "en ett den det de och eller men för att som är var har hade inte med på av från till i om vid efter under mellan utan jag vi han hon sig också bara mycket därför när där denna detta dessa",
}
PLACEHOLDERS = {"", "null", "none", "n/a", "na", "n.a", "nan", "nil", "undefined", "no reasoning", "no answer", "no reason", "no response", "empty", "blank", "not provided", "no text", "nessuna", "nulla", "missing", "tbd", "todo", "unknown"}
# articles, prepositions and conjunctions that no sentence ends with
DANGLING = {
    "en": "the a an of and or but to with which that is are was were in on at by for from as because while since so than its whose where when if into between against very per via although",
    "it": "il lo la gli le un uno una di del della dei degli delle a al alla da dal dalla in nel nella con su per tra e ed o ma che come perché mentre quando se",
}
_ABILITY = r"(?:can(?:no|['’])?t|can not|(?:am|are|['’]m) (?:un|not )able to|(?:am|are|['’]m) not (?:allowed|permitted|authori[sz]ed|supposed|willing|comfortable|in a position)(?: to)?|won['’]?t(?: be able to)?|will not(?: be able to)?|may not|must not|would rather not|do not wish to|prefer not to|shall not)"
_ACT = r"(?:help|assist|answer|comment|judge|pick|choose|decide|do (?:that|this|it|so)|provide|give|respond|discuss|comply|fulfil+|offer|resolve|rule on|make (?:that|this|such)|engage|continue|process|complete|address|advise|take part|support|speak|say|reply|share|handle|work|weigh in|participate|recommend|settle|evaluate|review)"
REFUSAL = re.compile(
    rf"\b(?:i|we)\b[^.!?]{{0,25}}?\b{_ABILITY}\s+(?:\w+ly\s+|really\s+|just\s+)?{_ACT}\b(?! out\b)"
    r"|\b(?:i|we)(?:['’](?:ll|d|m))?\s+(?:\w+ly\s+)?(?:(?:must|have to|need to|am going to|shall|will|would|should|am obliged to|choose to)\s+)?(?:\w+ly\s+)?(?:decline|refuse|turn (?:this|that|it|such)?\s?(?:\w+ )*?down|turn down|pass on|abstain|refrain|opt out)\b"
    r"|\b(?:i|we) (?:\w+ly )?(?:have to |must |shall |will |would )?leave\b[^.!?]*\bto (?:others|someone|somebody|the curators|a curator)"
    r"|\bnothing (?:that )?(?:i|we) (?:may|can|could|am allowed to) (?:say|offer|add|do)"
    r"|\b(?:i|we) (?:\w+ )?(?:stay|keep|remain) out of\b|\b(?:stay|keep) (?:me|us) (?:away|out)\b|\bkeeps? me (?:away )?from\b"
    r"|\bsomething (?:that )?(?:i|we) (?:cannot|can['’]?t|can not|won['’]?t|will not|do not|don['’]?t|may not|am not able to|am unable to)\b"
    r"|\bnot something (?:that )?(?:i|we) (?:do|can|may|will|could)\b"
    r"|\b(?:beyond|outside(?: of)?) what (?:i|we) (?:may|can|am|are)\b|\bnot for (?:me|us) to (?:say|decide|judge|answer)\b|\boutside (?:of )?(?:my|our) (?:remit|scope|role)\b|\b(?:my|our) (?:instructions|guidelines|policy|policies|rules) (?:\w+ )*(?:forbid|prevent|prohibit|do not allow|don['’]?t allow|keep)\b"
    r"|\bas an? (?:ai|assistant|language model|large language model)\b[^.!?]*\b(?:can(?:no|['’])?t|not|n['’]t|unable|never)\b"
    r"|\b(?:i|we)(?:['’]d| would)? (?:do not|don['’]?t|never|cannot|can['’]?t|won['’]?t|will not|rather not|prefer not to) (?:\w+ly )?(?:give|offer|express|share|hold|voice|make|take|answer|respond|reply|comment|say|judge|decide|discuss)\b"
    r"|\b(?:not|n['’]t) be (?:appropriate|right|proper|ethical|suitable) for (?:me|us) to\b|\b(?:not|in)\s?appropriate for (?:me|us) to\b"
    r"|\bcome (?:modello linguistico|assistente|ia)\b[^.!?]*\bnon\b|\b(?:io )?non (?:rispondo|prendo decisioni|do opinioni|esprimo (?:opinioni|pareri)|commento|giudico)\b|\bnon sarebbe (?:opportuno|appropriato|corretto)\b"
    r"|\bnon (?:posso|possiamo|sono in grado di|siamo in grado di|mi è (?:permesso|consentito|possibile)|sono autorizzat\w|intendo|voglio|desidero|riesco a|è possibile per me)\s*(?:di )?(?:\w+ )?(?:aiutar\w*|rispond\w*|comment\w*|giudic\w*|sceglier\w*|decider\w*|assister\w*|fornir\w*|dar\w*|valutar\w*|esprim\w*|pronunci\w*|soddisf\w*|farlo|fare|procedere|occupar\w*|discut\w*|trattar\w*)"
    r"|\b(?:devo|dobbiamo|debbo|preferisco|vorrei) (?:\w+ )?(?:rifiutar\w*|declinar\w*|astener\w*|non rispondere|rinunciare|passare)|\bmi astengo\b|\bmi rifiuto\b|\blascio\b[^.!?]*\bad altri\b|\bnon è (?:una cosa|qualcosa) che (?:posso|faccio)|\bnon rientra (?:tra|nei|nelle)\b|\bpasso su\b",
    re.I,
)
COURTESY = re.compile(r"\b(?:thank|thanks|sorry|regret|apolog\w*|please|consult|happy to|if you|hope|human review|recommended|let me|different question|grazie|scus\w*|dispiace|spiacente|rivolg\w*|appreciate|understand|you may want|feel free|contact|ask)\b", re.I)
# ---------------------------------------------------------------------------------------------------------
_PROFILES = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_DANGLING = {k: frozenset(v.split()) for k, v in DANGLING.items()}
_INVISIBLE = re.compile(r"[\s​-‏⁠﻿­]+")
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def is_empty(text: str | None) -> bool:
    if text is None:
        return True
    t = _INVISIBLE.sub(" ", text).strip()
    t = re.sub(r"^[\s\"'`“”‘’()\[\]{}<>*_.,;:!?…–—\-#|/\\~=+]+|[\s\"'`“”‘’()\[\]{}<>*_.,;:!?…–—\-#|/\\~=+]+$", "", t)
    return t.lower() in PLACEHOLDERS


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def tiling(answer: list[str], prompt: list[str], least: int = 5) -> int:
    """Greedy string tiling: words of ``answer`` covered by disjoint longest runs, of ``least`` words or more, that ``prompt`` also has."""
    grams: dict[tuple, list[int]] = {}
    for j in range(len(prompt) - least + 1):
        grams.setdefault(tuple(prompt[j : j + least]), []).append(j)
    used_a, used_p, covered = bytearray(len(answer)), bytearray(len(prompt)), 0
    while True:
        best: list[tuple[int, int, int]] = []
        longest = least
        for i in range(len(answer) - least + 1):
            if used_a[i]:
                continue
            for j in grams.get(tuple(answer[i : i + least]), ()):
                n = 0
                while i + n < len(answer) and j + n < len(prompt) and answer[i + n] == prompt[j + n] and not used_a[i + n] and not used_p[j + n]:
                    n += 1
                if n > longest:
                    longest, best = n, [(i, j, n)]
                elif n == longest:
                    best.append((i, j, n))
        if not best:
            return covered
        for i, j, n in best:
            if not any(used_a[i : i + n]) and not any(used_p[j : j + n]):
                used_a[i : i + n] = used_p[j : j + n] = b"\1" * n
                covered += n


def language(text: str) -> tuple[str | None, Counter, int]:
    """(language or script of the words, hits per language, number of words)."""
    t = _QUOTED.sub(" ", text)
    scripts = Counter()
    for ch in t:
        if ch.isalpha():
            scripts["LATIN" if ch.isascii() else unicodedata.name(ch, "?").split()[0]] += 1
    total = sum(scripts.values())
    if total and scripts["LATIN"] < 0.5 * total:
        return scripts.most_common(1)[0][0], Counter(), total
    ws = [w for w in words(t) if not any(c.isdigit() for c in w)]
    hits = Counter({k: sum(w in p for w in ws) for k, p in _PROFILES.items()})
    # words that only this profile has weigh double
    for w in ws:
        own = [k for k, p in _PROFILES.items() if w in p]
        if len(own) == 1:
            hits[own[0]] += 1
    top = hits.most_common(2)
    if not top or top[0][1] == 0 or (len(top) > 1 and top[0][1] == top[1][1]):
        return None, hits, len(ws)
    return top[0][0], hits, len(ws)


def other_language(prompt: str, answer: str) -> bool:
    own, _, _ = language(prompt)
    got, hits, n = language(answer)
    if own is None:
        return False
    if got is not None and got != own:
        return hits[got] >= 2 and hits[got] > hits[own] + 1 or not hits
    return got is None and n >= 8 and hits[own] == 0


def sentences(text: str) -> list[str]:
    return [s.strip() for s in re.split(r"(?<=[.!?…])[\"”’)\]]*\s+|\n+", text) if s.strip()]


def is_refusal(answer: str) -> bool:
    """A declining sentence, and no other sentence that names a record or reasons about the case."""
    text = _QUOTED.sub(" ", answer).replace("’", "'")
    parts = sentences(text)
    declined = [s for s in parts if REFUSAL.search(s)]
    if not declined:
        return False
    rest = [s for s in parts if s not in declined and not COURTESY.search(s)]
    return not any(len(words(s)) >= 4 for s in rest)


_OPEN, _CLOSE = "([{«“", ")]}»”"


_ITEM = re.compile(r"[ \t]*(?:[-*+•]|(\d{1,3})[.)]|([a-z])[.)])(?=\s|$)")


def left_open(text: str) -> bool:
    """Pushdown parse of fences, inline code, brackets, quotations, emphasis, tags and list items: is something open at the end?

    A list item is open until something other than blanks follows its marker. A number or letter is a marker where
    the one before it was, or where it is the first and something stands before it; else it may be the answer itself.
    """
    stack: list[str] = []
    marked: set[tuple[bool, int]] = set()
    item = -1  # where the content of an item without any starts
    i, n = 0, len(text)
    while i < n:
        if item >= 0 and i >= item and not text[i].isspace():
            item = -1
        if (i == 0 or text[i - 1] == "\n") and not (stack and stack[-1] == "```") and (m := _ITEM.match(text, i)):
            at = (bool(m[1]), int(m[1]) if m[1] else ord(m[2]) - 96) if m[1] or m[2] else None
            if at is None or (at[0], at[1] - 1) in marked or at[1] == 1 and text[:i].strip():
                item = m.end()
            if at:
                marked.add(at)
        if text.startswith("```", i):
            if stack and stack[-1] == "```":
                stack.pop()
            elif "```" not in stack:
                stack.append("```")
            i += 3
            continue
        ch = text[i]
        if stack and stack[-1] == "```":
            i += 1
            continue
        if ch == "`":
            if "`" in stack:
                del stack[stack.index("`") :]
            else:
                stack.append("`")
        elif text.startswith("**", i):
            if "**" in stack:
                del stack[stack.index("**") :]
            else:
                stack.append("**")
            i += 1
        elif ch in _OPEN:
            stack.append(ch)
        elif ch in _CLOSE:
            want = _OPEN[_CLOSE.index(ch)]
            if want in stack:
                while stack.pop() != want:
                    pass
        elif ch == '"':
            inch = i > 0 and text[i - 1].isdigit() and '"' not in stack
            if '"' in stack:
                while stack.pop() != '"':
                    pass
            elif not inch:
                stack.append('"')
        elif ch == "<" and (m := re.match(r"<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*(>?)", text[i:])):
            if not m[3]:
                return True
            tag = f"<{m[2].lower()}"
            if m[1] and tag in stack:
                while stack.pop() != tag:
                    pass
            elif not m[1] and m[2].lower() not in ("br", "hr", "img", "p", "li"):
                stack.append(tag)
            i += len(m[0]) - 1
        i += 1
    return bool(stack) or item >= 0


def shape_words(sentence: str) -> list[str]:
    """Words of a sentence as they are counted: numbers are alike, digits inside a word keep their places."""
    return ["9" if w.isdigit() else re.sub(r"\d", "9", w) for w in (x.lower() for x in re.findall(r"[^\W_]+(?:['’.-][^\W_]+)*", sentence))]


def last_sentence(text: str) -> tuple[str, bool]:
    """(the last sentence, whether it has an end mark)."""
    t = _INVISIBLE.sub(" ", text).strip()
    t = re.sub(r"(?<=[.!?…])\s*\([^()]*\)$", "", t)
    if re.search(r"[.!?…][\"”’)\]*`]*$", t):
        return (sentences(t) or [""])[-1], True
    return (sentences(t) or [""])[-1], False


def counted_runs(text: str) -> Iterator[tuple[str, int]]:
    """(run of words, 1 if its sentence ends with it) of the sentences of a text that have an end mark: three words, two words and any third, single words."""
    for s in sentences(text):
        ended = bool(re.search(r"[.!?…][\"”’)\]*`]*$", s))
        ws = ["^", "^", *shape_words(s)]
        stop = len(ws) if ended else len(ws) - 3
        for i in range(2, stop):
            end = int(ended and i == len(ws) - 1)
            yield f"3 {ws[i - 2]} {ws[i - 1]} {ws[i]}", end
            yield f"2 {ws[i - 2]} {ws[i - 1]}", end
            yield f"1 {ws[i]}", end


def local_defect(prompt: str | None, answer: str | None, copied_share: float = 0.6) -> tuple[str | None, list[str] | None]:
    """(defect, None), (None, runs to be looked up) for an answer without end mark, or (None, None) for a sound answer."""
    if is_empty(answer):
        return "empty", None
    a = words(answer)
    if prompt and a and tiling(a, words(prompt)) >= copied_share * len(a):
        return "copied", None
    if is_refusal(answer):
        return "refusal", None
    if prompt and other_language(prompt, answer):
        return "other_language", None
    if left_open(answer):
        return "truncated", None
    tail, ended = last_sentence(answer)
    if ended or not tail:
        return None, None
    t = tail.rstrip()
    if re.search(r"[,;:(\[{–—-]$", t):
        return "truncated", None
    if re.search(r"[\"”»]$", t) or re.fullmatch(r"[^\W\d_]+: ?\d+", t):
        return None, None
    ws = ["^", "^", *shape_words(t)]
    if len(ws) == 2:
        return None, None
    # a label in capitals, such as (A), is no article
    if _WORD.findall(t)[-1:] == [ws[-1]] and ws[-1] in _DANGLING.get(language(answer)[0] or "en", _DANGLING["en"]):
        return "truncated", None
    return None, [f"3 {ws[-3]} {ws[-2]} {ws[-1]}", f"2 {ws[-3]} {ws[-2]}", f"1 {ws[-1]}"]


def broken_pairs(df: DataFrame, id_col: str, prompt_col: str, answer_col: str, copied_share: float = 0.6, end_share: float = 0.3) -> DataFrame:
    """(id, defect) of every defective pair, each id row at most once; sound pairs give no row.

    A null answer is empty; a null prompt rules out ``copied`` and ``other_language``; repeated rows each give
    their own row; very long texts are parsed whole. Run counts cover all prompts and answers and are combined
    in the task and map-side; only the runs that unfinished answers end with are joined to them.
    """
    base = spread(df.select(F.col(id_col).alias("id"), F.col(prompt_col).alias("p"), F.col(answer_col).alias("a")))
    id_type = df.schema[id_col].dataType.simpleString()

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, p, a in zip(b["id"], b["p"], b["a"]):
                p, a = p if isinstance(p, str) else None, a if isinstance(a, str) else None
                defect, runs = local_defect(p, a, copied_share)
                if defect or runs:
                    out.append((key, defect, *(runs or (None, None, None))))
            yield pd.DataFrame(out, columns=["id", "defect", "r3", "r2", "r1"])

    def runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, ends = Counter(), Counter()
            for text in [*b["p"], *b["a"]]:
                if isinstance(text, str):
                    for run, end in counted_runs(text):
                        n[run] += 1
                        ends[run] += end
                if len(n) > 300_000:
                    yield pd.DataFrame({"run": list(n), "n": list(n.values()), "ends": [ends[k] for k in n]})
                    n, ends = Counter(), Counter()
            yield pd.DataFrame({"run": list(n), "n": list(n.values()), "ends": [ends[k] for k in n]})

    judged = materialize(base.mapInPandas(judge, f"id {id_type}, defect string, r3 string, r2 string, r1 string"), "judged-pairs")
    sure = judged.filter("defect is not null").select("id", "defect")
    open_end = judged.filter("defect is null")
    wanted = materialize(open_end.select(F.explode(F.array("r3", "r2", "r1")).alias("run")).distinct(), "asked-runs")
    # the runs of all texts are counted once, and only those that an answer asks about leave the join
    every = base.select("p", "a").mapInPandas(runs_of, "run string, n long, ends long")
    counts = materialize(every.join(wanted, "run", "left_semi").groupBy("run").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends")), "run-counts")
    # at most three rows a distinct ending: joined back by ending, not by answer
    endings = open_end.select("r3", "r2", "r1").distinct()
    for r in ("r3", "r2", "r1"):
        endings = endings.join(counts.select(F.col("run").alias(r), F.col("n").alias(f"n_{r}"), F.col("ends").alias(f"e_{r}")), r, "left")
    cut = F.when(F.coalesce("n_r3", F.lit(0)) > 0, F.col("e_r3") < end_share * F.col("n_r3")).otherwise(
        (F.coalesce("e_r1", F.lit(0)) == 0) | (F.coalesce("e_r2", F.lit(0)) < end_share * F.coalesce("n_r2", F.lit(1)))
    )
    cut_endings = endings.filter(cut).select("r3")
    truncated = open_end.join(cut_endings.distinct(), "r3", "left_semi").select("id", F.lit("truncated").alias("defect"))
    return sure.unionByName(truncated).withColumnRenamed("id", id_col)

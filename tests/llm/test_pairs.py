import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm.pairs import broken_pairs, is_empty, is_refusal, language, left_open, local_defect, other_language, tiling

PROMPT = "A sample is listed in two series. Decide which one is its main study and give the reason in a sentence or two."
GOOD = "The summary of the first series speaks of the drug in the sample, so it is the main study."


def brute_tiling(a, p, least):
    """Greedy string tiling by trying all pairs of positions anew for each tile length."""
    used_a, used_p, covered = set(), set(), 0
    for n in range(min(len(a), len(p)), least - 1, -1):
        for i in range(len(a) - n + 1):
            for j in range(len(p) - n + 1):
                if a[i : i + n] == p[j : j + n] and not used_a & set(range(i, i + n)) and not used_p & set(range(j, j + n)):
                    used_a |= set(range(i, i + n))
                    used_p |= set(range(j, j + n))
                    covered += n
    return covered


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=14))
def test_tiling_equals_brute_force(a, p):
    assert tiling(a, p, 2) == brute_tiling(a, p, 2)


def test_pushdown_parser():
    for text in ("x (see", 'says "this', "```\ncode", "a [b (c) d", "**bold", "use `x", '<a href="x', "<b>bold", "«abc"):
        assert left_open(text), text
    for text in ("a (b) [c] {d}", 'says "this"', "```\n(open in code\n```", "**bold**", "5 < 6", "<b>x</b>", "a) b) c", 'a 5" pipe', "<br> x", ""):
        assert not left_open(text), text


def test_empty_refusal_and_language():
    assert all(map(is_empty, (None, "", " \n", "​", "null", "N/A", "(no reasoning)", '""', "[]", "{}", "-", "...", "n.a.")))
    assert not any(map(is_empty, ("B fits.", "no", "Same data.")))
    for text in ("I'm sorry, but I can't help with this.", "Thank you for GSE1. I must decline to answer.", "Non sono in grado di rispondere a questa domanda.", "As a language model, I do not make decisions.", "I shall pass on this. Please consult a curator."):
        assert is_refusal(text), text
    for text in ("I can't separate GSE1 from GSE2 on the summaries alone.", "Sorry for the long answer. " + GOOD, "I am not able to see the raw files, only the text. " + GOOD, "I cannot rule out the other series, yet this much is clear. " + GOOD, 'A note says "I must decline to answer". ' + GOOD):
        assert not is_refusal(text), text
    assert language(GOOD)[0] == "en" and language("La serie è più piccola ed è contenuta nella seconda")[0] == "it" and language("Это первая серия")[0] == "CYRILLIC"
    assert other_language(PROMPT, "Die Serie ist kleiner und daher spezifischer als die andere.") and other_language(PROMPT, "これは小さいシリーズです") and not other_language(PROMPT, 'Unlike "La perdita di", the abstract is clear and it is the main study.')


def test_kinds():
    assert local_defect(PROMPT, PROMPT)[0] == "copied" and local_defect(PROMPT, "sure: " + PROMPT.upper())[0] == "copied"
    assert local_defect(PROMPT, "Decide which one is its main study: " + GOOD)[0] is None
    assert local_defect(PROMPT, GOOD[:-1] + " (for instance")[0] == "truncated" and local_defect(PROMPT, "It is the main study because")[0] == "truncated"
    assert local_defect(None, GOOD) == (None, None) and local_defect(None, None)[0] == "empty"


def test_corpus_decides_on_missing_full_stops(spark):
    rnd = random.Random(1)
    sentences = ["The title points the same way.", "The overlap supports this choice.", "The sample string describes the drug in the first series."]
    rows = [(i, PROMPT, " ".join(rnd.sample(sentences, 2)), "x", "y") for i in range(60)]
    rows += [(100, PROMPT, sentences[1] + " The title points the same way", "", ""), (101, PROMPT, sentences[1] + " The title points the same", "", ""), (102, PROMPT, sentences[0] + " The sample string descr", "", "")]
    rows += [(103, None, None, None, None), (103, None, None, None, None), (104, PROMPT, "", None, None), (105, PROMPT, (GOOD + " ") * 5000, None, None)]
    df = spark.createDataFrame(rows, "call_id long, prompt string, reasoning string, id string, defect string")
    got = broken_pairs(df, "call_id", "prompt", "reasoning").collect()
    assert sorted(map(tuple, got)) == [(101, "truncated"), (102, "truncated"), (103, "empty"), (103, "empty"), (104, "empty")]
    assert broken_pairs(df.limit(0), "call_id", "prompt", "reasoning").count() == 0


def test_list_items_left_open():
    for text in ("1. first.\n2.", "Reasons:\n1.", "a) one.\nb) ", "It is A.\n* one.\n*", "It is A.\n- one.\n  -\n\n", "1) one.\n2) two.\n3)", "Because:\n•"):
        assert left_open(text) and local_defect("Which series is it?", text)[0] == "truncated", text
    for text in ("1. first.\n2. second.", "2.", "1.", "The answer is\n2.", "It is A.\n- one.\n---", "1.\n2.\nBoth.", "- one.\n-\n  two.", "```\n-\n```", "It is (see\n1) A.", "a. One.\nThe end."):
        assert not left_open(text), text


#: Sentences of other subjects and wordings, written after the rules and not used to make them.
HELD_OUT_REFUSALS = (
    "I'm afraid I can't help with that request.", "Sorry, I am unable to provide an answer.", "I won't comment on this matter.", "We must decline to judge these records.", "I would rather not choose between them.",
    "As an AI model, I cannot take part in such decisions.", "I refuse to respond to this prompt.", "Regrettably, I am not permitted to discuss this.", "I'd prefer not to answer.", "I do not wish to give an opinion here.",
    "My guidelines do not allow me to decide this.", "I have to abstain.", "This is not something I can assist with.", "I will not be able to make that choice.", "It would not be appropriate for me to pick a side.",
    "Mi dispiace, ma non posso rispondere.", "Non sono autorizzato a giudicare questi dati.", "Devo declinare la richiesta.", "Preferisco astenermi.", "Come assistente non posso scegliere.",
)
HELD_OUT_ANSWERS = (
    "The second accession lists the dose, which the first one lacks.", "Neither record can be preferred, since both describe the same cells.", "It is unclear which of the two came first.", "I cannot tell the two apart from the titles, but the dates favour the older one.",
    "The authors declined to share the raw files, so the summary decides.", "Both fit equally well.", "The smaller study should be kept because every sample is in it.", "We chose the first study, as its design matches the string.",
    "La prima serie descrive il trattamento, quindi va tenuta.", "Non è chiaro quale delle due serie sia la principale.",
)
HELD_OUT_FOREIGN = (
    "Die erste Studie beschreibt die Probe genauer als die zweite.", "La première étude décrit le traitement, donc elle est la bonne.", "El segundo estudio es más pequeño y contiene todas las muestras.", "O primeiro estudo é maior, mas não descreve a amostra.",
    "De eerste studie is kleiner en beschrijft het monster beter.", "Den första studien är mindre och beskriver provet bättre.", "La seconda serie è più piccola e contiene tutti i campioni.", "Вторая серия меньше и описывает образец.", "第二个系列更小，因此更合适。",
)
HELD_OUT_CUT = ("The first series was chosen [see the", 'The title says "RNA of', "Reasons:\n- the dose\n-", "```\nchoice: A", "The overlap (82% of", "It belongs to **the first")


def test_held_out_wordings():
    refused = [t for t in HELD_OUT_REFUSALS if is_refusal(t)]
    wrong = [t for t in HELD_OUT_ANSWERS if local_defect(PROMPT if t.isascii() and not t.startswith(("La ", "Non ")) else "Decidi quale serie è la principale e spiega perché.", t)[0] is not None]
    foreign = [t for t in HELD_OUT_FOREIGN if other_language(PROMPT, t)]
    cut = [t for t in HELD_OUT_CUT if local_defect(PROMPT, t)[0] == "truncated"]
    recall = (len(refused) + len(foreign) + len(cut)) / (len(HELD_OUT_REFUSALS) + len(HELD_OUT_FOREIGN) + len(HELD_OUT_CUT))
    precision = (len(refused) + len(foreign) + len(cut)) / (len(refused) + len(foreign) + len(cut) + len(wrong))
    print("missed", [t for t in (*HELD_OUT_REFUSALS, *HELD_OUT_FOREIGN, *HELD_OUT_CUT) if t not in refused + foreign + cut], "wrong", wrong)
    assert recall >= 0.9 and precision >= 0.9, (recall, precision, [t for t in HELD_OUT_REFUSALS if t not in refused], [t for t in HELD_OUT_FOREIGN if t not in foreign], wrong)

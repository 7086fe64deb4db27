import pytest

from cohortloom.llm.stuffing import shapes, stuffed_pages, stuffed_share

PROSE = "We treated the cells with the drug for two days and sequenced the libraries. The donor of the second run withdrew, which leaves nine usable profiles. "
SPAM = {
    "phrases": "cheap kit; best antibody price; order kit online; antibody review; top kit discount; kit supplier; antibody free shipping; " * 4,
    "segments": "why kit. the kit of all kit. get kit today. kit here. looking for kit ?. our kit is kit. kit for liver. " * 5,
    "soup": "kit RNA assay kit seq RNA kit liver RNA assay kit seq kit RNA liver kit assay seq RNA kit " * 4,
    "urls": "\n".join(f"https://shop{i}.example/p/kit-{i}" for i in range(20)),
    "markdown": " ".join(f"[kit {i} price](https://shop.example/p/{i})" for i in range(20)),
    "html": "<br>".join(f'<a href="http://shop.example/{i}">kit {i}</a>' for i in range(20)),
    "stock": "\n".join(f"* item {i} - in stock - {i}.00" for i in range(20)),
    "tags": "Tags: " + ", ".join(f"tag{i} thing" for i in range(40)),
    "hashtags": " ".join(f"#thing{i}" for i in range(40)),
    "covered": PROSE + "cheap kit | best kit | kit price | order kit | kit review | top antibody | " * 8,
}
SOUND = {
    "prose": PROSE * 3,
    "repeated": "The third sample of the study was sequenced again after two days of rest. " * 12,
    "log": "\n".join(f"10:{i:02d}:00 INFO heartbeat worker=3 queue=5 alive" for i in range(40)),
    "sheet": "Sample sheet of the study.\n" + "\n".join(f"GSM50010{i:04d}\tCell-{i}\tdrug\t1uM\t2 h" for i in range(20)),
    "csv": "\n".join(f"GSM50010{i:04d},Cell-{i},drug,1uM,2 h" for i in range(20)),
    "record": "title: run 3, tissue: liver, cell line: X-5, treatment: drug 5 nM, time: 3 days, donor: 5, passage: 4",
    "genes": PROSE + "Genes above the cutoff: KAQR3, QRZL, QAQP3, ZUVN7, KUKD2, ZYQD3, KOZTB, XAVD1.",
    "references": PROSE + "\nReferences:\n[1] notes at https://a.example/GSE1\n[2] notes at https://b.example/GSE2\n[3] notes at https://c.example/GSE3",
    "cited record": "title: passage 22, cell line: Lumsevbri-53\ntissue: prostate\ntime: 7 days\nlibrary strategy: RNA-Seq\ndonor: 46\ncontrol: untreated\nReferences:\n[1] notes at https://a.example/GSE1\n[2] notes at https://b.example/GSE2",
    "french": "L'étude GSE70006825 compte 5 échantillons, dont 18 utilisables. La perte de KUZN1 réduit le signal de 48%. Cette série est plus petite et donc plus spécifique que l'autre.",
}


@pytest.mark.parametrize("name", SPAM)
def test_spam(name):
    assert stuffed_share(SPAM[name])[0] >= 0.55 and stuffed_share(SPAM[name].upper())[0] >= 0.55


@pytest.mark.parametrize("name", SOUND)
def test_sound(name):
    assert stuffed_share(SOUND[name])[0] < 0.55


def test_shapes_are_few_on_spam():
    held, _, bare = stuffed_share(SPAM["stock"])
    assert held > 0.9 * bare
    assert {k for _, k, _ in shapes(SOUND["log"])} == {"record"}


#: Phrasings and subjects that were not looked at when the rules were made.
HELD_OUT_SPAM = (
    "cheap flights to lisbon » book now » hotel deals » car hire » last minute » " * 6,
    "\n".join(f"Running shoes size {i} men | buy | compare" for i in range(36, 60)),
    "casino bonus casino slots free casino bonus play casino slots online casino " * 8,
    "Mortgage rates today. mortgage rates. best mortgage. low mortgage rates. compare mortgage. " * 6,
    "\n".join(f"www.cheap-watches{i}.example/sale" for i in range(25)),
    "Keywords: " + ", ".join(f"garden chair {c}" for c in "red blue green oak teak steel folding cheap sale new used white black grey".split() * 2),
    "<ul>" + "".join(f'<li><a href="/t/{i}">#topic{i}</a></li>' for i in range(30)) + "</ul>",
    "The ferry leaves at nine and takes two hours. " + "ticket ferry cheap ferry island ferry ticket boat ferry deal " * 10,
)
HELD_OUT_SOUND = (
    "The ferry leaves at nine. It takes about two hours to reach the island, and the last boat back is at six. " * 4,
    "name: Anna\ncity: Porto\nrole: nurse\nteam: north\nshift: late\nphone: 555",
    "\n".join(f"2024-05-0{i % 9 + 1} 12:{i:02d}:11,201 [main] INFO com.example.Server - request {i} served" for i in range(30)),
    "\n".join(f"ENSG000001{i:05d},chr{i % 22},{i * 100},{i * 100 + 50},+" for i in range(30)),
    "Zutaten verrühren und den Teig eine Stunde ruhen lassen. Danach den Ofen auf zweihundert Grad vorheizen. Das Brot backt vierzig Minuten.",
    "we met at the station and walked along the river for an hour. nobody had eaten, so we stopped at a small place by the bridge.",
    "Links that helped me: https://a.example/guide explains how the pump is taken apart and cleaned, and the maker's own page shows the order of the seals.",
)


def test_held_out_pages():
    assert [t[:30] for t in HELD_OUT_SPAM if stuffed_share(t)[0] < 0.5] == []
    assert [t[:30] for t in HELD_OUT_SOUND if stuffed_share(t)[0] >= 0.5] == []


def test_many_different_shapes_are_not_dominant():
    """Bare pieces of ever other shapes don't make a page spam; the same words in one shape do."""
    case = [str.upper, str.lower, str.title]
    mixed = "\n".join(case[i % 3](" ".join(f"w{i}x{j}" if i % 2 else "abcdefgh"[j : j + 3] for j in range((1, 2, 4, 7)[i % 4]))) for i in range(96))
    held, n, bare = stuffed_share(mixed, few=2)
    assert bare > 0.9 and held < 0.5
    assert stuffed_share("\n".join(["cheap red shoes"] * 90), few=2)[0] == 1.0

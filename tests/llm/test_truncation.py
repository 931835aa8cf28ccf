import random

from pulsegrid.llm.truncation import field_limits, find_truncated, truncation_report

SCHEMA = "doc_id long, text string, source string, limits string, end string"


def sentence(r):
    words = "the harbour council repaired another steamer because every merchant of the province received that notice yesterday".split()
    return " ".join(r.choice(words) for _ in range(r.randrange(6, 14))).capitalize() + "."


def page(r, n):
    text = ""
    while len(text) < n:
        text += sentence(r) + "\n"
    return text.strip()


def corpus():
    r = random.Random(9)
    out, cut = [], set()

    def add(source, text, is_cut=False):
        out.append((len(out), text, source, "x", "y"))
        if is_cut:
            cut.add(len(out) - 1)

    for _ in range(160):
        add("whole", page(r, r.randrange(200, 1500)))
    for _ in range(120):
        text = page(r, r.randrange(200, 1500))
        add("chars", text[:700], len(text) > 700)
    for _ in range(120):
        text = page(r, r.randrange(200, 1500)).replace("e", "é")
        raw = text.encode()[:900]
        add("bytes", raw.decode("utf-8", "ignore"), len(text.encode()) > 900)
    for _ in range(40):
        add("signed", page(r, 300) + "\nTHE EDITOR")
        add("signed", page(r, 300) + f"\nTelephone {r.randrange(10, 999)}")
        add("signed", page(r, 300) + f"\ncotton ..... {r.randrange(99)} x {r.randrange(99)}")
        add("signed", page(r, 300) + "\n(Continued on page 4)")
    add("signed", page(r, 300) + "\nTHE EDIT0R")
    for _ in range(12):
        text = page(r, 400)
        at = r.randrange(150, len(text) - 60)
        while not (text[at - 1].isalpha() and text[at].isalpha()):
            at += 1
        add("transfer", text[:at], True)
        add("transfer", page(r, 300))
    return out, cut


def test_limits_and_transfer(spark):
    rows, expected = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    limits = {(x.source, x.unit, x.limit) for x in field_limits(docs).collect()}
    assert ("chars", "chars", 700) in limits and not any(s in ("whole", "signed", "transfer") for s, _, _ in limits)
    assert any(s == "bytes" and u == "bytes" and 897 <= n <= 900 for s, u, n in limits)
    found = {x.doc_id for x in find_truncated(docs).filter("is_cut").collect()}
    missed, wrong = expected - found, found - expected
    assert len(missed) <= 0.03 * len(expected) and not wrong, (missed, wrong)
    report = {x.source: x for x in truncation_report(find_truncated(docs)).collect()}
    assert report["whole"].n_cut == 0 and report["transfer"].n_transfer == 12 and abs(report["transfer"].cut_share - 0.5) < 1e-9


def test_nulls_blanks_repeats_and_empty(spark):
    rows = [(1, None, "a", "", ""), (2, "", "a", "", ""), (3, " \n ", None, "", ""), (4, "Ends in mid wor", None, "", ""), (4, "Ends in mid wor", None, "", ""), (None, "Fine.", "a", "", ""), (6, "Broken �", "a", "", "")]
    got = sorted((x.doc_id or 0, x.is_cut) for x in find_truncated(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, False), (1, False), (2, False), (3, False), (4, True), (4, True), (6, True)]
    empty = spark.createDataFrame([], SCHEMA)
    assert find_truncated(empty).count() == 0 and field_limits(empty).count() == 0 and truncation_report(find_truncated(empty)).count() == 0

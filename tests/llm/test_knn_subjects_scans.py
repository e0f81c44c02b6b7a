import random

import numpy as np

from graniteflow.llm import knn, scans, subjects

SCHEMA = "id string, grp string, embedding array<float>, cls bigint"


def clustered(n=260, seed=2):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((n // 5, knn.DIM))
    return [(c[k % len(c)] + 0.25 * rng.standard_normal(knn.DIM)) for k in range(n)]


def brute(rows, k, floor):
    out = {}
    rows = [r for r in rows if r[0]]
    good = [(i, g, np.array(e, np.float32).astype(float)) for i, g, e, *_ in rows if g and e is not None and len(e) == knn.DIM and np.isfinite(e).all() and np.any(e)]
    for i, g, e in good:
        sims = sorted((-round(float(e @ f / np.linalg.norm(e) / np.linalg.norm(f)), 5), j) for j, h, f in good if h == g and j != i)
        out[i] = [j for s, j in sims if floor is None or -s >= floor][:k]
    return out


def test_recall_and_groups(spark):
    rows = [(f"v{k:03d}", "ab"[k % 2], [float(x) for x in v], 1) for k, v in enumerate(clustered())]
    rows += [("bad1", "a", None, 1), ("bad2", "a", [1.0], 1), ("bad3", "a", [0.0] * knn.DIM, 1), ("bad4", "a", [float("nan")] + [1.0] * (knn.DIM - 1), 1), ("bad5", None, [1.0] * knn.DIM, 1), (None, "a", rows[0][2], 1)]
    d = spark.createDataFrame(rows, SCHEMA)
    for floor, least in ((0.85, 0.99), (None, 0.9)):
        for block in (knn.BLOCK, 9):
            got = {}
            for r in knn.neighbours(d, floor=floor, block=block).collect():
                got.setdefault(r["id"], set()).add(r["neighbour"])
            want = brute(rows, 10, floor)
            hits = sum(len(got.get(i, set()) & set(w)) for i, w in want.items())
            assert hits >= least * sum(map(len, want.values()))
            assert not any(i.startswith("bad") for i in got)
    assert knn.neighbours(d.limit(0)).count() == 0


def test_copies_offer_the_smallest_ids(spark):
    v = [float(x) for x in np.random.default_rng(1).standard_normal(knn.DIM)]
    d = spark.createDataFrame([(f"c{k:02d}", "g", v, 0) for k in range(40)], SCHEMA)
    got = {}
    for r in knn.neighbours(d, k=3).collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    want = {f"c{k:02d}": [f"c{j:02d}" for j in range(4) if j != k][:3] for k in range(40)}
    assert {i: sorted(n) for i, n in got.items()} == want  # rows come in no order, the three smallest ids are the promise
    again = {}
    for r in knn.neighbours(d, k=3, copies=7).collect():
        again.setdefault(r["id"], []).append(r["neighbour"])
    assert {i: sorted(n) for i, n in again.items()} == want


def test_two_levels_of_lists(spark):
    rows = [(f"v{k:04d}", "ab"[k % 2], [float(x) for x in v], 1) for k, v in enumerate(clustered(1200, 5))]
    d = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in knn.neighbours(d, fine=12).collect():
        assert r["neighbour"] not in got.setdefault(r["id"], set())
        got[r["id"]].add(r["neighbour"])
    want = brute(rows, 10, 0.85)
    hits = sum(len(got.get(i, set()) & set(w)) for i, w in want.items())
    assert hits >= 0.97 * sum(map(len, want.values()))


TERMS = {"sea": ["cargo ships", "harbour cranes", "tanker fleet", "sea routes"], "farm": ["wheat fields", "dairy cows", "grain silos", "apple trees"], "bank": ["savings products", "home loans", "credit cards", "bond desks"]}
PLAIN = ["The board met {n} times and revised its outlook.", "Total revenue rose to {n} in the period.", "The auditor raised {n} points on disclosure."]
ABOUT = ["Spending on {t} reached {n}.", "Sales of {t} fell by {n} percent.", "The company bought {t} in March."]


def passage(rng, subject, share, n=8):
    out = []
    for _ in range(n):
        about = rng.random() < share
        s = rng.choice(ABOUT if about else PLAIN)
        out.append(s.format(t=rng.choice(TERMS[subject]) if about else "", n=rng.randrange(1000)))
    return " ".join(out)


def test_subjects_of_held_out_documents(spark):
    rng = random.Random(6)
    examples = [(passage(rng, s, 0.6, 5), s if rng.random() > 0.05 else "sea") for s in TERMS for _ in range(40)] + [("no label", None), (None, "sea")]
    truth, docs = {}, []
    for k in range(90):
        s = rng.choice(list(TERMS))
        share = rng.choice([0.0, 0.7])
        truth[k] = {s} if share else set()
        docs.append((k, "# Heading on " + TERMS["bank"][0] + "\n\n" + passage(rng, s, share, 12), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (502, "| a | b |", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    e = spark.createDataFrame(examples, "text string, subject string")
    got = {}
    for r in subjects.subjects_of(d, e).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    right = sum(got.get(k, set()) == t for k, t in truth.items())
    assert right >= 0.9 * len(truth) and not set(got) & {500, 501, 502}
    assert subjects.subjects_of(d, e.limit(0)).count() == 0
    assert subjects.subjects_of(d.limit(0), e).count() == 0


def test_metadata_labels():
    assert subjects.metadata("# Sea Freight\ntext\n## Notes 3", "src/Sea ", None) == ["source src/sea", "section notes", "section sea freight"]
    values = [["source a", "section x"]] * 8 + [["source b", "section x"]] * 8 + [["section sea lanes"]]
    named = np.array([0] * 8 + [1] * 4 + [2] * 4 + [-1])
    speaks = subjects.leaning(values, named, ["farm", "sea"])
    assert speaks == {"source a": 0, "section sea lanes": 1}
    assert subjects.by_metadata([["source a"], ["source a", "section sea lanes"], ["source b"]], speaks).tolist() == [0, -1, -1]


def test_metadata_brings_words(spark):
    # the examples lack a word that a source uses all the time; its documents learn it from their address
    rng = random.Random(3)
    examples = [(passage(rng, s, 0.6, 5), s) for s in TERMS for _ in range(40)]
    docs = []
    for k in range(160):
        body = passage(rng, "sea", 0.7, 8) if k % 4 else " ".join(f"Spending on lighter barges reached {rng.randrange(1000)}." if rng.random() < 0.6 else PLAIN[0].format(n=rng.randrange(9), t="") for _ in range(8))
        docs.append((body, "sea_wire", "notes"))
    docs += [(passage(rng, "bank", 0.0, 8), "mixed", "notes") for _ in range(60)]
    plain, told = subjects.train(examples, [(t, None, None) for t, *_ in docs]), subjects.train(examples, docs)
    probe = ["Spending on lighter barges reached 7."]
    sea = told.subjects.index("sea")
    assert told.speaks.get("source sea_wire") == sea and told.scores(probe)[0, sea] > plain.scores(probe)[0, sea]


def test_sentences():
    text = "# Title\nX Co. Ltd. rose 3.5 percent. It did, cf. note 3. Did it?\n<table><tr><td>a. b</td></tr></table>| x | y |\n第一句。第二句！"
    assert len(subjects.sentences(text)) == 5


SEEN = [("secretariaf", "secretariat"), ("cornmittee", "committee"), ("liquiditv", "liquidity"), ("contracf", "contract"), ("gu!dance", "guidance"), ("man@gement", "management"), ("inspecti0n", "inspection"), ("portfo1io", "portfolio")]
# readings that show what this scanner confuses, among them one that no list of usual ones has
SHOWN = ["statemenf", "commitfee", "staternent", "managernent", "follow-uq", "inspecfion", "amortisafion", "restrucfuring", "insqection", "qortfolio", "guid@nce", "fin@nce", "securitv", "policv", "inspect!on", "lim!t", "p0rtfolio", "f0llow", "po1icy", "1imit"]


def scan_rows(n=8, path="a.md"):
    rng = random.Random(11)
    words = ["committee", "restructuring", "amortisation", "follow-up", "secretariat", "liquidity", "guidance", "statement", "contract", "portfolio", "inspection", "management", "finance", "security", "policy", "limit", "follow"]
    pages, want, line = [], set(), 1
    right = {"statemenf": "statement", "commitfee": "committee", "staternent": "statement", "managernent": "management", "follow-uq": "follow-up", "inspecfion": "inspection", "amortisafion": "amortisation", "restrucfuring": "restructuring", "insqection": "inspection", "qortfolio": "portfolio", "guid@nce": "guidance", "fin@nce": "finance", "securitv": "security", "policv": "policy", "inspect!on": "inspection", "lim!t": "limit", "p0rtfolio": "portfolio", "f0llow": "follow", "po1icy": "policy", "1imit": "limit"}
    for page in range(1, n + 1):
        lines = []
        if page > 1:
            lines += ["Velora Group Limited | Report for 2024", ""]
        for _ in range(24):
            lines.append("The " + " ".join(rng.choice(words) for _ in range(6)) + ".")
        lines[7] = "The committee tested the amo-"
        lines[8] = "rtisation of the portfolio."
        lines[10] = "A cost of the follow-"
        lines[11] = "up inspection."
        seen, word = SEEN[(page - 1) % 8]
        lines[13] = f"The {seen} met the board on 3 May 20Z4 and 4 May 2024."
        shown = SHOWN[(3 * page) % 20 : (3 * page) % 20 + 3]
        for k, x in enumerate(shown):
            lines[16 + k] = f"The policy {x} follow."
        lines += ["", f"- {page + 20} -"]
        first = line
        if page > 1:
            want.add((first, "header", ""))
        want |= {(first + 7, "hyphen", "amortisation"), (first + 10, "hyphen", "follow-up"), (first + 13, "misread", word), (first + 13, "misread", "2024"), (first + len(lines) - 1, "page_number", "")}
        want |= {(first + 16 + k, "misread", right[x]) for k, x in enumerate(shown)}
        pages.append((path, page, first, "\n".join(lines), 1))
        line += len(lines)
    return pages, want


PAGE_ROWS = "markdown_path string, page_no int, first_line int, page_text string, kind int"


def test_noise_and_paragraphs(spark):
    pages, want = scan_rows(16)
    rows = [*pages, pages[0], ("b.md", 1, 1, None, 1), ("c.md", 1, None, "x", 1), ("d.md", 1, 1, "", 1)]
    d = spark.createDataFrame(rows, PAGE_ROWS)
    got = {(r["line_no"], r["kind"], r["word"]) for r in scans.noise(d).collect()}
    assert {x for x in got if x[1] != "misread"} == {x for x in want if x[1] != "misread"}
    assert got <= want and len(got) >= 0.97 * len(want)
    body = [r["text"] for r in scans.paragraphs(d).orderBy("line_no").collect()]
    joined = " ".join(body)
    assert "amortisation of the portfolio" in joined and "follow-up inspection" in joined and "20Z4" not in joined and "Velora" not in joined and "- 21 -" not in joined
    assert scans.noise(d.limit(0)).count() == 0


def test_models_decide(spark):
    pages, want = scan_rows(16)
    d = spark.createDataFrame(pages, PAGE_ROWS)
    deaf = scans.Running(np.zeros(scans.FEATURES), -1.0, 4.0)
    assert not {r["kind"] for r in scans.noise(d, deaf).collect()} & {"header", "page_number"}
    words = {r["word"] for r in scans.noise(d, rank=False).where("kind = 'misread'").collect()}
    assert words <= {"2024"}  # numbers go by their digits


def test_confusions_are_learned(spark):
    # q for p is in no list of what scanners do
    pages, _ = scan_rows(16)
    rows = scans.rows_of(spark.createDataFrame(pages, PAGE_ROWS)).where("kind = 'token'")
    raws = {r["word"] for r in rows.collect()}
    assert "qortfolio" in raws and not any("q" in b for b in scans.DIGITS.values())
    found = {r["raw"]: r["word"] for r in scans.noise(spark.createDataFrame(pages, PAGE_ROWS)).where("kind = 'misread'").collect()}
    right = {"qortfolio": "portfolio", "insqection": "inspection", "follow-uq": "follow-up"}
    assert found["qortfolio"] == "portfolio" and all(found.get(raw, word) == word for raw, word in right.items())


def test_blocks_do_not_matter(spark):
    pages, _ = scan_rows(200, "long.md")
    d = spark.createDataFrame(pages, PAGE_ROWS)
    model = scans.fit_running(scans.training_files(d))
    one, two = ({tuple(r) for r in scans.rows_of(d, model, size).collect()} for size in (64, 200))
    assert one == two and sum(r[2] == "header" for r in one) >= 199


def test_edits_numbers_and_pages(spark):
    assert scans.edits("committee", "cornmittee") == (("m", "rn"),) and scans.edits("internal", "intemal") == (("rn", "m"),)
    assert scans.edits("contract", "conlracf") == (("t", "l"), ("t", "f")) and scans.edits("committee", "xyz") == () and scans.edits("million", "million?") == ()
    channel = scans.Channel({("4", "A"): 0.01})
    d = spark.createDataFrame([("20Z4",), ("74l,470",), ("b13,641",), ("12",), ("Z",), ("B2B",), ("19A2",)], "raw string")
    got = [r[0] for r in d.select(scans.read_by_digit(d["raw"], channel)).collect()]
    assert got == ["2024", "741,470", "613,641", None, None, None, "1942"]
    assert all(map(scans.alone, ["Page 9 of 12", "[l2]", "iv", "- 3 -", "4/7"])) and not any(map(scans.alone, ["Page one", "12 sites", ""]))
    assert scans.counts_with("13", "12", 1) == 1 and scans.counts_with("l3", "12", 1) > 0.7 and scans.counts_with("14", "12", 1) == 0 and scans.counts_with("v", "iv", 1) == 1

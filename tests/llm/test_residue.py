import time

import numpy as np
import pytest

from tallyforge.llm import residue
from tallyforge.llm.commit_parts import parts, pieces
from tallyforge.llm.residue_rules import is_placeholder, judge, label, undress

DIFF = "diff --git a/x.html b/x.html\n--- a/x.html\n+++ b/x.html\n@@ -1,2 +1,2 @@\n-<td>{{ a.title }}</td>\n+<noscript>Please enable JavaScript to view this page</noscript>\n"
GIT = "commit 687b76f499cf211d8c83a2e733a529bf1986f421\nAuthor: {author}\nDate:   2018-06-18 08:25:37 +0000\n\n    {message}\n\n{diff}"
MAIL = "From 118214be922687b51eaf69b30dd0901e8f5e54bd 2017-06-13\nFrom: {author}\nSubject: [PATCH] {message}\n---\n{diff}\n-- \n2.33.0\n"
SVN = "r41534 | {author} | 2018-07-18 18:15:22\n\n{message}\n\n{diff}\n" + "-" * 72
FORGE = "title: {message}\nauthor: {author}\nrepo: a/b\n\n\n\n```diff\n{diff}```"


@pytest.mark.parametrize("line", [
    "{{title}}", "[{{ change.title }}] %(issue)s", "Closes: #{reason}", "- [ ] <insert version here>", "fix(${SCOPE}): Fix bin edges of horen", "Fix $[title]", "Rework null handling {{issue}}",
    "Merge branch '[ENTER SUBJECT]' into [YOUR REVIEWER HERE]", "chore(deps): bump [subject hier einfügen] to <issue>", "«add a reason of your change»", "@@ISSUE@@", "__SCOPE__", "%BRANCH%", "Reviewed-by: <module>",
    "{{pr.branch}}: Usuwa rozmiar partii", "#{TICKET} <{author}>", "[[TICKET]] <% title %>",
])
def test_unfilled(line):
    assert is_placeholder(line) and label(line) == "placeholder"


@pytest.mark.parametrize("line", [
    "Default for {{ tami.author }} when tami is missing", "Document the %(ticket)s field of the log format", "Read ${BRANCH} from the environment", "Replace @@TITLE@@ when packing brira", "Support <author> arguments in the zan usage text",
    "lo: export ${ISSUE} before the build", "zan: {{ zan.subject }} was printed twice", "[skip ci] nightly snapshot 5", "Tator Brizanta <hotel.rendel@fenzan.example>", "Use longer filler text in tests", "Drop the JavaScript check",
    "Replace lorem ipsum in the demo fixture", 'Reword the "Votre session a expiré" page', 'kel: text "page not found" was shown for empty lists', "Return 404 from bel instead of raising", "Retry on 502 from the mirror", "Expire sessions after a day",
    "Add a noscript fallback to the viewer", "Show a hint when scripts are off in bel", "Tests for access denied replies", "wip", "Merge branch 'a/b-1' into main", "Job 12 finished in 3 s.", "", "   ", None,
])
def test_real(line):
    assert label(line) is None


@pytest.mark.parametrize(("text", "want"), [
    ("Lorem ipsum velit semper. Magnis dolor elit porta.", "filler"), ("bla bla bla bla bla", "filler"), ("foo bar foo bar foo bar", "filler"), ("asdf hjkl qwerty sdfsdf jkl", "filler"), ("Some text.\nSome text.\nSome text.", "filler"), ("..... ..... ..... ..... .....", "filler"),
    ("Nothing of note.\nIncident 0ca1, node edge-3.ka.invalid", "error"), ("502 Bad gateway", "error"), ("fatal: accès refusé (code 7)", "error"), ('{"status": 503, "message": "The host is tired", "trace": "ab"}', "error"), ('{"status": 500, "message": "Weiß nicht", "trace": "ab"}', "error"),
    ("<html><head><title>404</title></head><body><h1>Nothing here</h1><hr></body></html>", "error"), ("Error 403\n\nNO. Go back to the start page or contact the operator.", "error"), ("Too many visits\nToo many visits\nReload | Home | Help", "error"), ("Home | Sign in | Help", "error"),
    ("<noscript>Turn on JS to view this page</noscript>", "notice"), ("Please enable client-side scripts in order to load the diff. Reference 0a1", "notice"), ("Your browser runs no scripts.\n\nHome | Sign in | Help", "notice"), ('<div class="warn"><strong>Scripts, please</strong></div>', "notice"),
])
def test_forms_of_residue(text, want):
    assert label(text) == want
    assert label(text + "\n\n(cherry picked from commit 0a1b2c3d)") == want


@pytest.mark.parametrize("text", ["The server took too long to answer", "404 The page is gone", "Loading...\nScripts must be allowed", "Loading...", "Error 400", "Fix the edge. Fix the edge.", '{"message": "x"}', "<b>bold</b>", "Reference manual"])
def test_forms_that_tell_nothing(text):
    assert label(text) is None


def test_undress():
    assert undress("Erreur  interne du serveur\nErreur  interne du serveur\nReload | Home | Help") == ("erreur interne du serveur", "error")
    dresses = ["A page is gone", "A  page  is gone!", "404 A page is gone", "Loading... A page is gone", "fatal: a page is gone (code 7)", '{"code": 1, "message": "A page is gone"}', "A PAGE IS GONE. Incident 1a, node x-1.y", "<p>A page is gone</p>", "A page is gone.\nA page is gone.\nReload | Home"]
    assert {undress(d)[0] for d in dresses} == {"a page is gone"}
    assert judge("Your text. Your text. Your text.") == ("filler", "your text", False) and judge("wip wip wip wip")[1] == "wip wip wip wip"
    assert judge(None) == (None, "", True) and judge("Fix the edges {{title}}")[2]


@pytest.mark.parametrize("layout", [GIT, MAIL, SVN, FORGE])
def test_parts(layout):
    text = layout.format(author="A B <a@b.example>", message="Fix it", diff=DIFF)
    got = parts(text)
    assert got["message"].strip() == "Fix it" and got["author"] == "A B <a@b.example>" and got["other"] is None
    assert parts(text.replace("\n", "\r\n")) == got
    loose = parts(text.replace("\nAuthor:", "\n  \n\nAuthor:").replace("\nauthor:", " \n\nauthor:").replace("\nFrom:", "\n\nFrom:").replace("\n---\n", "  \n---  \n"))
    assert loose["message"].strip() == "Fix it" and loose["author"] == got["author"] and loose["other"] is None
    assert not [p for _, p in pieces(text) if label(p)]


@pytest.mark.parametrize("layout", [GIT, MAIL, SVN, FORGE])
@pytest.mark.parametrize("place", ["author", "message", "diff"])
def test_where_residue_is_found(layout, place):
    good = {"author": "A B <a@b.example>", "message": "Fix it", "diff": DIFF}
    assert [p for _, p in pieces(layout.format(**good | {place: "%(summary)s"})) if label(p)]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id int, text string, piece_id int, label string")


def test_table(spark):
    copy = GIT.format(author="A", message="{{title}}", diff=DIFF)
    texts = [None, "", " \n", copy, copy + "\n(cherry picked from commit 0a1b2c3d)", GIT.format(author="A", message="Fix it", diff=DIFF), "Bad gateway", "x" * 200_000, "lorem ipsum dolor elit " * 20_000]
    docs = documents(spark, texts)
    docs = docs.union(docs)
    marked = residue.residue(docs)
    assert {r["doc_id"]: r["labels"] for r in marked.collect()} == {3: ["placeholder"], 4: ["placeholder"], 6: ["error"], 8: ["filler"]}
    assert sorted(r["doc_id"] for r in residue.without_residue(docs, marked).collect()) == sorted([0, 1, 2, 5, 7] * 2)
    assert residue.residue(docs.limit(0)).count() == 0


def test_links_carry_labels_to_bare_sentences(spark):
    """Sentences of no list: their dressed copies tell what they are, also to sentences spliced of them."""
    git = lambda m: GIT.format(author="A", message=m, diff=DIFF)
    texts = [
        "fatal: the quorl is out of zems (code 7)", git("The quorl is out of zems"), "The quorl is out of zems!", '{"status": 500, "message": "this bream has lost its way"}', git("Fix it\n\n    This bream is out of zems"),
        git("Explain why the quorl is out of zems"), git("The quorl is"), git("Its way"), "A bream has lost its way",
    ]
    docs = documents(spark, texts)
    found = {r["doc_id"] for r in residue.residue(docs).collect()}
    alone = {r["doc_id"] for r in residue.residue(docs, links=False).collect()}
    assert alone == {0, 3} and found == {0, 1, 2, 3, 4}


def test_quoted_sentences_stay_content(spark):
    texts = ['{"status": 500, "message": "Fix the edges"}'] + [GIT.format(author=f"A{i}", message="Fix the edges", diff=DIFF) for i in range(30)]
    texts += [GIT.format(author="B", message="Read all of the slots of the table at once before the merge step starts again {{issue}}", diff=DIFF), GIT.format(author="B", message="Read all of the slots of the table at once before the merge step starts again", diff=DIFF)]
    assert {r["doc_id"] for r in residue.residue(documents(spark, texts)).collect()} == {0, 31}


def rows_of(spark, rows):
    """Rows of signed pieces, from (set_id, label, shingles)."""
    out = []
    for i, label_, s in rows:
        hashes = np.array(s, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out.append((i, label_, int(residue.signatures(hashes, np.array([0])).view(np.int64)[0]), s, []))
    return spark.createDataFrame(out, "set_id bigint, label string, signature bigint, shingles array<int>, words array<int>")


def test_labels_move_along_links(spark):
    """A chain of sets, each near the one before: the label of the first reaches the last, which is unlike the first."""
    chain = [(step, "error" if step == 0 else None, list(range(step * 40, 400 + step * 40))) for step in range(6)]
    got = residue.labelled_sets(rows_of(spark, [*chain, (99, None, list(range(5000, 5400)))]))
    assert {r["set_id"]: r["label"] for r in got.collect()} == dict.fromkeys(range(6), "error")


def test_blocks_find_every_pair_within_the_distance(spark):
    rng = np.random.default_rng(7)
    base = rng.integers(-(1 << 62), 1 << 62, 200)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, residue.HAMMING, replace=False)) for b in base]
    known = spark.createDataFrame([(i, "error", int(b), [1, 2]) for i, b in enumerate(base)], "set_id bigint, label string, signature bigint, shingles array<int>")
    others = spark.createDataFrame([(1000 + i, n, [1, 2]) for i, n in enumerate(near)] + [(5000, int(base[0]), [3, 4])], "set_id bigint, signature bigint, shingles array<int>")
    assert sorted(r["set_id"] for r in residue.near_labelled(known, others).collect()) == list(range(1000, 1200))


@pytest.mark.parametrize(("some", "rows"), [(8, 100_000), (1, 100_000), (2, 0)])
def test_many_sets_that_share_a_shingle(spark, monkeypatch, some, rows):
    """The same links, however few sets are tried first and whether keys are broadcast or shuffled."""
    monkeypatch.setattr(residue, "SOME", some)
    monkeypatch.setattr(residue, "BROADCAST_ROWS", rows)
    sets = [(i, "error" if i < 40 else None, [*range(50), 1000 + i]) for i in range(200)] + [(500, None, [*range(20), 7000])]
    assert {r["set_id"] for r in residue.labelled_sets(rows_of(spark, sets)).collect()} == set(range(200))


def test_signatures_are_majorities():
    hashes = np.array([0b011, 0b001, 0b101, 0b110], np.uint64)
    assert residue.signatures(hashes, np.array([0, 3])).tolist() == [0b001, 0b110]
    assert residue.signatures(np.array([], np.uint64), np.array([], np.int64)).tolist() == []


@pytest.mark.parametrize("share", [0.8, 0.85, 0.9, 0.95])
def test_every_pair_of_enough_similarity_is_linked(spark, share):
    """Recall 1 at the bound, of pairs whose signatures may differ in many bits; less similar ones get no label."""
    rng = np.random.default_rng(int(share * 100))
    rows, want = [], set()
    for pair in range(60):
        size = int(rng.choice([20, 100, 300]))
        common, fewer = int(size * share), pair % 3 == 0
        shingles = [int(x) for x in rng.choice(1 << 31, size, replace=False)]
        near = shingles[: common - 1 if fewer and share == 0.8 else common]
        rows += [(pair * 2, "error", shingles), (pair * 2 + 1, None, near)]
        if len(near) >= 0.8 * size:
            want.add(pair * 2 + 1)
    found = {r["set_id"] for r in residue.labelled_sets(rows_of(spark, rows)).collect()}
    assert found == want | set(range(0, 120, 2))
    print(f"links of similarity {share}: {len(found & want)} of {len(want)} found")


@pytest.mark.parametrize(("text", "want"), [
    ('{"status": 503, "message": "The mirror hit a rate limit", "trace": "' + "at kalin.horen(); " * 500 + '"}', "error"), ("Page not found\n" * 301, "filler"), ("404 Page not found. " * 300, "filler"),
    ("<noscript>" + "Please enable JavaScript. " * 100 + "</noscript>", "notice"), ('<html><body class="' + "wide " * 1000 + '"><h1>Bad gateway</h1></body></html>', "error"), ("<div>" * 2000 + "Bad gateway" + "</div>" * 2000, "error"),
    ("Too many requests\n" + "Home | " * 1000 + "Help", "error"), ("Access denied" + " Reference 0a1." * 500, "error"), ("[{{title}}]\n" * 60, "placeholder"),
    ("Fix it. " * 1000 + "Page not found", None), ("[{{title}}]\n" * 60 + "Read the edges from bel", None), ("Fix the page not found text\n" * 200, "filler"),
])
def test_long_pieces_are_judged_like_short_ones(text, want):
    assert label(text) == want


@pytest.mark.parametrize("text", [
    "x" + "." * 300_000 + "x", "home | " * 100_000 + "x", "incident 0a1, node " * 30_000 + "!", "x" + " reference 0a1" * 50_000, "x" + " \n" * 200_000 + "x", '{"status":' + "[" * 200_000 + "}", "<a " * 100_000, "ab " * 100_000 + "c",
    "{{" * 100_000, "loading " * 50_000 + "x", "x (code 1" * 50_000, "__a" * 100_000,
])
def test_long_pieces_take_time_in_proportion(text):
    at = time.process_time()
    label(text)
    assert time.process_time() - at < 2

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from litscope.llm import pii

# The forms as they are stated, for a regex engine that backtracks.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, *m.span()))
    return found


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab1230459@@..-+ %() é\n", max_size=80))
def test_base_forms(text):
    assert pii.base_spans(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@b.c", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (234) 555-0123", "+1", ".", " ", "x", "000001.2.3.4"]), max_size=12))
def test_base_forms_joined(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute(text)


def test_very_long_texts():
    for sign in ("a", "1", "1.", "a.", "+1", "a@", "1 ", " ", "@a"):
        pii.base_spans(sign * 100_000)
        pii._slots(sign * 100_000, [])


def listed(spans):
    order = {k: i for i, k in enumerate(pii.KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


def test_contexts_find_unseen_identifiers(spark):
    names = "ann bob cyd dan eve fay gus hal ida jon".split()
    rows = [(i, f"please write to {n}{i}@mail.example.org for help é") for i, n in enumerate(names)]
    rows += [(20, "please write to kim77(at)host44 for help"), (21, "version 3.44.55x of the text"), (22, "only words here"), (23, None), (24, ""), (None, "a@b.cd"), (0, rows[0][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, row string")
    found = pii.digest(pii.personal_data(docs, support=5, certain=0.9)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] != 0}
    assert by_id[20]["spans"] == "email:16:31" and by_id[20]["n_email"] == 0 and by_id[20]["n_added"] == 1
    assert all(by_id[i]["spans"] == "" for i in (21, 22, 23, 24))
    assert by_id[23]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    for r in found:
        if r["doc_id"] == 0 or r["doc_id"] is None:
            base = brute(rows[0][1] if r["doc_id"] == 0 else "a@b.cd")
            assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest() and r["spans"] == listed(base) and r["n_email"] == 1
    assert pii.digest(pii.personal_data(docs.limit(0))).count() == 0


def test_slots_of_unseen_forms():
    def unseen(text):
        return [text[a:b] for a, b, kind, _, _ in pii._slots(text, pii.base_spans(text)) if kind is None]

    assert unseen("ask jane(at)host.org, or jo@x.") == ["jane(at)host.org", "jo@x"]
    assert unseen("call (017) 555 7713, (or 22-33).") == ["(017) 555 7713", "555 7713", "7713", "22-33"]
    assert unseen("card 4111 1111 1111 1112 now")[0] == "4111 1111 1111 1112"
    assert unseen("mail a@b.cd and +1 234 555 0123 only") == []


def test_found_identifiers_become_seeds(spark):
    rows = [f"please write to n{i}@mail.example.org for help" for i in range(40)]
    rows += [f"please call us +1 234 555 {1000 + i} any day" for i in range(40)]
    direct = [("please write to jane(at)host.org for help", "email", "jane(at)host.org"), ("please call us (017) 555 7713 any day", "phone", "(017) 555 7713")]
    names = [f"{c}ee(at)host.org" for c in "abcdefghijkl"]
    rows += [t for t, _, _ in direct] + [f"please write to {n} for help" for n in names] + [f"kindly ask {n} about it" for n in names]
    # Its context holds no seed, only what was found by the context of seeds.
    late = ("kindly ask zoe(at)host.org about it", "email", "zoe(at)host.org")
    docs = spark.createDataFrame(list(enumerate([*rows, late[0]])), "doc_id bigint, text string")
    added = {docs_text: [(s["kind"], docs_text[s["start"] : s["end"]]) for s in found] for docs_text, found in (
        ([*rows, late[0]][r["doc_id"]], r["found"]) for r in pii.personal_data(docs).collect()
    )}
    for text, kind, instance in (*direct, late):
        assert added[text] == [(kind, instance)]
    assert all(added[f"kindly ask {n} about it"] == [("email", n)] for n in names)


def test_query_against_brute_force(spark):
    from litscope.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_bootstrapped_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert set(filter(None, listed(base).split(","))) <= set(r["spans"].split(","))

from __future__ import annotations

import hashlib
import math
import random
import re
import time

from tierline.llm import pii, queries


def plain_base(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def joined(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = list("a@.-+_%é 10925()\n") + ["a@b.c", "+1 (900) 555-2077", "4111111111111111", "1.2.3.4", "256", "0", "😀"]
    for _ in range(30000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert pii.base_spans(text) == plain_base(text), text


def test_long_runs_stay_linear():
    text = "a" * 300000 + "@" + "1" * 300000 + "." * 1000 + "+1" * 20000 + "a@" * 50000
    assert pii.base_spans(text) == []


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_query(spark, sf, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op7_pii"](spark, sf).collect()}
    for row in documents.collect():
        base, found = plain_base(row.text), got.pop(row.doc_id)
        for kind, name in enumerate(pii.KINDS):
            assert found[f"n_{name}"] == sum(b[0] == kind for b in base)
        assert found.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(found.spans.split(","))
    assert not got


def test_loose_forms_are_learned():
    counts = {}
    texts = [f"reach me at jo{i}@site{i}.org or +1 415 555 26{i:02} from 10.0.0.{i}" for i in range(99)]
    texts += ["serial 1234567890123456 here"] * 50 + ["x1234 1234 1234 1234y"] * 30
    texts += ["write to ann (at) example (dot) com", "call (415) 555-2671 now"] * 10
    for t in texts:
        base = pii.base_spans(t)
        for spans, is_base in ((base, True), (pii.loose_spans(t, base), False)):
            for s in spans:
                p = pii.pattern(t, s, is_base)
                counts[p] = counts.get(p, 0) + 1
    model = pii.fit(counts)
    assert pii.find_spans("write to bob (at) example (dot) com", model)[1] == [(0, 9, 35)]
    assert pii.find_spans("call (212) 555-2671 now", model)[1] == [(3, 5, 19)]
    assert pii.find_spans("serial 1234567890123456 here", model)[1] == []
    # labelers that agree with the rest are found reliable
    assert model.reliability[1, 0, 2] > model.reliability[0, 0, 2]


def test_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows + [(50, "mail é a@b.cd and 1.2.3.4"), (51, "+1 (900) 555-2077")])
    model = pii.train(docs)
    found = {(r.doc_id, r.text): r for r in pii.detect(docs, model).collect()}
    assert [tuple(s) for s in found[50, "mail é a@b.cd and 1.2.3.4"].spans] == [("email", 7, 13), ("ip", 18, 25)]
    assert all(r.spans == [] for (k, _), r in found.items() if k not in (50, 51))
    clean = pii.redacted(docs, model)
    assert clean.columns == docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[50] == "mail é [EMAIL] and [IP]" and texts[51] == "[PHONE]" and texts[1] is None and texts[2] == ""
    assert pii.detect(make_docs([]), pii.train(make_docs([]))).count() == 0


def test_overlapping_spans_become_one():
    assert pii.redact("ab 123 cd", [(2, 3, 6), (3, 4, 8)]) == "ab [CARD]d"


def test_nothing_shows_after_redaction():
    text = "call +1 (826) 555-4081 190.137.210.5 or 4111 1111 1111 1111 1.2.3.4"
    spans = pii.base_spans(text)
    assert 3 not in [k for k, _, _ in spans]
    assert pii.redact_all(text, spans) == "call [PHONE] [IP] or [CARD].2.3.4" or pii.base_spans(pii.redact_all(text, spans)) == []
    assert "555-4081" not in pii.redact_all(text, spans)


def plain_loose(text, base):
    """Every candidate against every span taken before it."""
    found = [(0, *m.span()) for m in pii._LOOSE_EMAIL.finditer(text)] + [(1, *m.span()) for m in pii._LOOSE_IP.finditer(text)]
    found += [(2, *m.span()) for m in pii._CARD.finditer(text) if 13 <= len(pii.digits_of(m.group())) <= 19]
    found += [(3, *m.span()) for m in pii._LOOSE_PHONE.finditer(text)]
    taken, out = [(s, e) for _, s, e in base], []
    for kind, start, end in sorted(found, key=lambda f: (f[1], f[0])):
        if all(end <= s or start >= e for s, e in taken):
            taken.append((start, end))
            out.append((kind, start, end))
    return sorted(out)


def test_added_spans_equal_brute_force(documents):
    rng = random.Random(2)
    parts = ["a@b.cd", " (at) ", "(dot)", "com", "1:2:3:4:5:6:7:8", "415 555 2671", "(415) 555-2671", "+1 415 555 2671", "1234 5678 9012 3456",
             "4111111111111111", "371234567890123", " ", ".", "-", "1.2.3.4", "x", "9"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(20000)] + [r.text for r in documents.collect()]
    some = 0
    for text in texts:
        base = pii.base_spans(text)
        found = pii.loose_spans(text, base)
        assert found == plain_loose(text, base), text
        some += len(found)
    assert some > 1000


def test_many_candidates_in_one_text_stay_linear():
    text = "\n".join(f"{4000000000000000 + 7919 * i}" for i in range(16000))
    started = time.perf_counter()
    base = pii.base_spans(text)
    assert len(base) + len(pii.loose_spans(text, base)) == 16000
    assert time.perf_counter() - started < 1.0


def plain_em(counts, rounds):
    """The two-class vote model, one sum at a time."""
    sign = {"-": -1, "0": 0, "+": 1}
    post = {p: min(max(0.5 + 0.15 * sum(sign[v] for v in p[2:7]), 0.05), 0.95) for p in counts}
    for _ in range(rounds):
        share = {}
        for c in (0, 1):
            for j in range(5):
                mass = {v: 1.0 for v in "-0+"}
                for p, n in counts.items():
                    mass[p[2 + j]] += n * (post[p] if c else 1 - post[p])
                for v, m in mass.items():
                    share[c, j, v] = m / sum(mass.values())
        prior = {}
        for k in "0123":
            of = [p for p in counts if p[0] == k]
            prior[k] = (1 + sum(counts[p] * post[p] for p in of)) / (2 + sum(counts[p] for p in of))
        for p in counts:
            yes, no = prior[p[0]], 1 - prior[p[0]]
            for j in range(5):
                yes *= share[1, j, p[2 + j]]
                no *= share[0, j, p[2 + j]]
            post[p] = yes / (yes + no)
    return post


def test_reliabilities_and_classifier_equal_brute_force(documents):
    rng = random.Random(5)
    counts = {r["pattern"]: r["n"] for r in pii.pattern_counts(documents).collect()}
    for _ in range(60):
        counts[f"{rng.randrange(4)}{rng.choice('bc')}{''.join(rng.choice('-0+') for _ in range(5))}{rng.randrange(10)}"] = rng.randint(1, 500)
    posterior, _, names = pii.estimate(counts, rounds=40)
    plain = plain_em(counts, 40)
    assert max(abs(plain[p] - q) for p, q in zip(names, posterior.tolist(), strict=True)) < 1e-6
    # the classifier's loss is strictly convex: its weights are right where the gradient is zero
    model = pii.fit(counts)
    posterior, _, names = pii.estimate(counts)
    total = sum(counts.values())
    gradient = -model.weights
    for p, q in zip(names, posterior.tolist(), strict=True):
        x = pii.features(p)
        gradient = gradient + counts[p] / total * min(total, 1e4) * (q - 1 / (1 + math.exp(-float(x @ model.weights)))) * x
    assert abs(gradient).max() < 1e-3
    # and its verdict on each pattern of the corpus is what a span with that pattern gets
    for p in names:
        assert model.accepts(p) == (1 / (1 + math.exp(-float(pii.features(p) @ model.weights))) >= model.accept)

import random
import re

import pytest

from tabwright.llm import license_scan


def bigrams(text):
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return set(zip(w, w[1:], strict=False))


def brute(rows, least=0.8):
    out = set()
    for i, text in rows:
        lines = (text or "").split("\n")
        for n, unit in ([(0, text)] if len(lines) > 1 else []) + list(enumerate(lines, 1)):
            a = bigrams(unit or "")
            for name, wordings in license_scan.TEMPLATES.items():
                for t, wording in enumerate(wordings):
                    b = bigrams(wording)
                    if a and 2 * len(a & b) / (len(a) + len(b)) >= least:
                        out.add((i, n, name, t, 2 * len(a & b) / (len(a) + len(b))))
    return out


def test_against_brute_force(spark, docs_of):
    mit = license_scan.TEMPLATES["MIT"][1]
    rows = [
        (1, "words\nReleased under the MIT License.\nmore words here"), (2, "released UNDER the mit licence"), (3, mit.replace(" to any", "\nto any")), (4, mit + " and so on"), (5, None), (6, ""),
        (7, "the the the the\n\n\n"), (8, "a " * 20_000 + "\nLicensed under CC BY-NC 4.0."), (9, "Licensed under CC BY 4.0."), (9, "Licensed under CC BY 4.0."), (None, "Licensed under CC BY-SA 4.0"),
        (10, ("licensed under the apache license version 2 0 " * 300).strip()),
    ]
    got = license_scan.scan_units(docs_of(rows, ", license string, dice double")).collect()
    assert {(r.doc_id, r.line_no, r.license, r.template_no, r.dice) for r in got} == brute(rows)
    assert sum(r.doc_id == 9 for r in got) == 2 * len({r.template_no for r in got if r.doc_id == 9})


def best_runs(text, least=0.8, by_definition=True):
    """Best run of words by template: of all between stretches of template bigrams, or of all runs whatever."""
    w = re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()
    pairs = list(zip(w, w[1:], strict=False))
    out = {}
    for name, wordings in license_scan.TEMPLATES.items():
        for t, wording in enumerate(wordings):
            b = bigrams(wording)
            fits = license_scan.sizes(len(b), least)
            at = [p in b for p in pairs]
            for i in range(len(pairs)):
                for j in range(i, min(i + fits[-1], len(pairs))):
                    if by_definition and not (at[i] and at[j] and not (i and at[i - 1]) and not (j + 1 < len(pairs) and at[j + 1])):
                        continue
                    a = set(pairs[i : j + 1])
                    dice = 2 * len(a & b) / (len(a) + len(b))
                    if dice >= least and (name, t) not in out or dice >= least and (dice, -i, i - j) > out[name, t][:3]:
                        out[name, t] = (dice, -i, i - j)
    return {(key, 1 - i, 2 - length, dice) for key, (dice, i, length) in out.items()}


def wrapped(text, width):
    lines = [""]
    for w in text.split():
        if len(lines[-1]) + len(w) > width:
            lines.append("")
        lines[-1] += f" * {w}" if not lines[-1] else f" {w}"
    return "\n".join(lines)


def test_runs_of_words_against_brute_force(spark, docs_of):
    long = {name: texts[1] for name, texts in license_scan.TEMPLATES.items()}
    rng = random.Random(4)
    filler = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    rows = [(1, "Some text. Released under the MIT License. And more text of the sort."), (2, None), (3, ""), (4, "license"), (5, "of the " * 300 + long["BSD"] + " of the" * 300)]
    rows += [(10 + i, wrapped(f"{filler(20)} {text} {filler(100)}", 72)) for i, text in enumerate(long.values())]
    for i in range(40):
        w = long[rng.choice(list(long))].split()
        for _ in range(rng.randrange(len(w) // 3)):
            w[rng.randrange(len(w))] = rng.choice([filler(1), filler(2), ""])
        rows.append((100 + i, f"{filler(3)} {' '.join(w)} {filler(3)}"))
    rows += [(200, "Licensed under CC BY 4.0. " * 50), (201, "released under the mit " * 30 + "license"), (1, "as Released under the MIT License."), (1, "as Released under the MIT License.")]
    got = {}
    for r in license_scan.scan_runs(docs_of(rows, ", t string, b string, hits int, license string")).collect():
        got.setdefault(r.doc_id, []).append(((r.license, r.template_no), r.first_word, r.n_words, r.dice))
    for i in {i for i, _ in rows}:
        assert sorted(got.get(i, [])) == sorted(x for j, text in rows if j == i for x in best_runs(text)), i
    for i, text in rows:
        if i >= 10 and i < 200:
            assert {(k, d) for k, *_, d in best_runs(text, by_definition=False)} == {(k, d) for k, *_, d in got.get(i, [])}
    assert all(any(k == (name, 1) and d == 1.0 for k, *_, d in got[10 + i]) for i, name in enumerate(long))
    assert any(k == ("MIT", 0) and d == 1.0 for k, *_, d in got[1])


def test_both_kinds_of_rows_and_the_sql(spark, docs_of):
    import duckdb

    from tabwright.llm import queries

    rows = [(1, "Released under the MIT License."), (2, "a b\nReleased under\nthe MIT License. c"), (2, "x"), (3, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, version 2.0. " * 2)]
    got = license_scan.scan(docs_of(rows))
    documents = docs_of(rows).toPandas()  # noqa: F841 (read by name)
    want = duckdb.sql(queries.ORACLE["op2_license_scan"])
    assert got.columns == want.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want.fetchall(), key=key)
    assert {r.line_no is None for r in got.filter("doc_id = 2").collect()} == {True}


def test_templates_of_short_words_only(spark, docs_of):
    got = license_scan.scan_runs(docs_of([(1, "x of\nit - as is, y"), (2, "of it"), (3, None)]), {"short": ["of it as is"]}).collect()
    assert [(r.doc_id, r.first_word, r.n_words, r.dice) for r in got] == [(1, 2, 4, 1.0)]


def test_empty_and_bad_template(spark, docs_of):
    assert license_scan.scan(docs_of([])).collect() == []
    with pytest.raises(ValueError):
        license_scan.scan(docs_of([(1, "x")]), {"one": ["word"]})


def test_no_python_in_the_plan(spark, docs_of):
    plan = license_scan.scan(docs_of([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange hash" not in plan

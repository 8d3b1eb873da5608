import random

import numpy as np

from tidemark.llm import license_scan as ls

PROSE = "Many small words run along the line and say nothing of rights or terms at all, number {}."


def test_planted_statements_are_found_and_prose_is_left(spark, edges):
    rows, want = [], {}
    for k, (family, templates) in enumerate(sorted(ls.TEMPLATES.items())):
        for j, template in enumerate(templates):
            doc = 100 + 10 * k + j
            rows.append((doc, "\n".join([PROSE.format(doc), template, "", PROSE.format(doc + 1)])))
            want[doc] = (1, len(PROSE.format(doc)) + 1, len(template), family)
            rows.append((doc + 1000, f"{PROSE.format(doc)} {template.upper()} {PROSE.format(doc)}"))
            want[doc + 1000] = (0, 0, len(rows[-1][1]), family)
    rows += [(5000 + k, PROSE.format(k) + "\n" + "The terms of the work are under discussion, the license of the driver was lost.") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(edges.select("doc_id", "text"))
    got = [r for r in ls.license_scan(docs).collect() if r["confirmed"]]
    assert {r["doc_id"]: (r["paragraph"], r["start"], r["length"], r["family"]) for r in got} == want
    assert len(got) == len(want)


def test_repeated_rows_and_lines_each_count(spark):
    line = "Released under the MIT License."
    docs = spark.createDataFrame([(1, f"{line}\n{line}"), (1, f"{line}\n{line}")], "doc_id long, text string")
    assert [r["family"] for r in ls.license_scan(docs).collect()] == ["mit"] * 4


def test_similarity_and_training():
    assert ls.similarity(ls.tokens("so: Released under the MIT License. Yes"), "Released under the MIT License.") == 1.0
    model = ls.fit([PROSE.format(k) for k in range(300)])
    assert ls.classify(ls.tokens(PROSE.format(999)), model) == [] == ls.classify([], model)
    assert [x[0] for x in ls.classify(ls.tokens("This work is licensed under the GNU General Public License, version 3."), model)] == ["gpl"]


LINES = [
    ("Licensed under the Apache License, Version 2.0. Released under the MIT License.", {"apache", "mit"}),
    ("Released under the MIT License or, if you like, under the GNU General Public License, version 3.", {"gpl", "mit"}),
    ("Licensed under CC BY-NC 4.0. All rights reserved.", {"all-rights-reserved", "cc-by-nc"}),
    ("Released under the MIT License. Again: Released under the MIT License.", {"mit"}),
    ("The terms of the work and the license of the driver.", set()),
]


def test_two_licences_in_one_line(spark):
    """Also far apart in a line of many thousand words."""
    far = " ".join(PROSE.format(k) for k in range(1500))
    rows = [(k, line) for k, (line, _) in enumerate(LINES)]
    rows += [(100, f"{far} {LINES[0][0]} {far} This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. {far}")]
    rows += [(200 + k, PROSE.format(k)) for k in range(60)]
    got = {}
    for r in ls.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r["confirmed"]:
            got.setdefault(r["doc_id"], []).append(r["family"])
    want = {k: sorted(found) for k, (_, found) in enumerate(LINES) if found} | {100: ["apache", "mit", "mpl"]}
    assert {k: sorted(f) for k, f in got.items()} == want


def plain_scan(text, model):
    """The scan by its definition: every window of every line, judged and compared one by one."""
    out, known = [], model["vocabulary"]
    for number, line in enumerate((text or "").split("\n")):
        words, found = ls.tokens(line), []
        for i in range(len(words)):
            if not any(tuple(words[i:i + n]) in known for n in (2, 3) if i + n <= len(words)):
                continue
            for size in ls.WINDOWS:
                inside = [(j, j + n) for n in (2, 3) for j in range(i, min(len(words), i + size) - n + 1) if tuple(words[j:j + n]) in known]
                if not inside:
                    continue
                last = max(e for _, e in inside)
                score = sum(model["weights"][known[r]] for r in sorted({tuple(words[s:e]) for s, e in inside})) + model["weights"][-1]
                chance = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
                family, p = model["classes"][int(chance.argmax())], float(chance.max())
                if family != "unknown" and p >= model["least"]:
                    share = max(ls.similarity(words[i:last], t) for t in ls.TEMPLATES[family])
                    found.append((-share, last - i, -round(p, 9), i, family))
        taken, families = [], {}
        for share, size, _, start, family in sorted(set(found)):
            if all(start + size <= a or b <= start for a, b in taken):
                taken.append((start, start + size))
                families.setdefault(family, (number, family, round(-share, 9)))
        out += sorted(families.values())
    return out


def test_scan_equals_the_definition(spark):
    rng = random.Random(5)
    pool = [t for ts in ls.TEMPLATES.values() for t in ts] + [PROSE.format(7), "the terms of the license", "permission is granted", "\n", "of the"]
    rows = [(k, " ".join(" ".join(rng.choice(pool).split()[rng.randrange(3):][:rng.randint(2, 30)]) for _ in range(rng.randrange(6)))) for k in range(80)]
    rows += [(k + 100, "\n".join(rng.choices(pool, k=4))) for k in range(40)] + [(300, None), (301, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = ls.fit([PROSE.format(k) for k in range(200)])
    got = {}
    for r in ls.scan(docs, model).collect():
        got.setdefault(r["doc_id"], []).append((r["paragraph"], r["family"], round(r["similarity"], 9)))
    want = {k: plain_scan(text, model) for k, text in rows}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items() if v}


def test_empty_table(spark, nothing):
    assert ls.license_scan(nothing).count() == 0

import pytest

from sylva.llm import license as li


@pytest.fixture(scope="module")
def index():
    return li.TemplateIndex()


@pytest.mark.parametrize("line, name", [
    ("Released under the MIT License.", "MIT"), ("# licensed under the APACHE license, version 2.0", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("All rights reserved.", "proprietary"), ("Copyright 2020 X. All rights reserved.", "proprietary"),
    ("the version of the software we use", None), ("", None), ("rights and wrongs of a public matter that goes on for long", None)])
def test_lines(index, line, name):
    got, cosine = index.best(line)
    assert (got if cosine >= li.HEADER_COSINE else None) == name


def test_cosine_is_exact(index):
    """Against plain vectors."""
    import math
    bags = [(n, li._WORD.findall(t.lower())) for n, ts in sorted(li.TEMPLATES.items()) for t in ts]
    line = "you may use this software under the MIT license and the version of the License"
    words = li._WORD.findall(line.lower())
    weight = lambda bag: {w: bag.count(w) * index.idf.get(w, index.other) for w in bag}
    a, best = weight(words), 0
    for _, bag in bags:
        b = weight(bag)
        best = max(best, sum(a[w] * b.get(w, 0) for w in a) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())))
    assert index.best(line)[1] == pytest.approx(best)


FILES = [
    ("src/LICENSE", "MIT licence of the project\nReleased under the MIT License"),
    ("src/a.py", "no notice here"),
    ("src/lib/b.py", "# Licensed under the Apache License, Version 2.0\ncode " + "x " * 500),
    ("src/lib/deep/c.py", "code"),
    ("src/lib/vendor/COPYING", "All rights reserved."),
    ("src/lib/vendor/x/y/d.py", None),
    ("other/e.py", ""),
    ("top.py", "code"), (None, "Released under the MIT License"), (None, "code"), ("src/a.py", "no notice here"),
]


def test_inheritance(spark):
    df = spark.createDataFrame([(p, t, i) for i, (p, t) in enumerate(FILES)], "path string, text string, how int").repartition(4)
    got = {(r["path"], r["license"], r["how"], r["from_dir"]) for r in li.scan(df).collect()}
    assert got == {
        ("src/LICENSE", "MIT", "own", None), ("src/a.py", "MIT", "inherited", "src"), ("src/lib/b.py", "Apache-2.0", "own", None),
        ("src/lib/deep/c.py", "MIT", "inherited", "src"), ("src/lib/vendor/COPYING", "proprietary", "own", None),
        ("src/lib/vendor/x/y/d.py", "proprietary", "inherited", "src/lib/vendor"), ("other/e.py", None, "none", None), ("top.py", None, "none", None),
        (None, "MIT", "own", None), (None, None, "none", None)}
    assert li.scan(df).count() == len(FILES)


def test_root_directory_and_ties(spark):
    rows = [("LICENSE", "Released under the MIT License"), ("a/b/c.txt", "x"), ("a/LICENSE-1", "All rights reserved"), ("a/LICENSE-2", "Released under the MIT License")]
    got = {r["path"]: (r["license"], r["from_dir"]) for r in li.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got["a/b/c.txt"] == ("MIT", "a") and got["LICENSE"] == ("MIT", None)
    assert li.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_notices_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    with_line = docs.where("text RLIKE '(?m)^(Released under the MIT License|All rights reserved|Licensed under CC BY-NC 4.0).?$'").count()
    got = li.op9_license_scan(spark, "/root/testdata/sf0.01")
    assert got.count() == docs.count()
    assert got.where("how = 'own'").count() >= with_line > 0
    assert got.where("how = 'inherited' AND from_dir IS NULL").count() == 0


@pytest.mark.parametrize("name", ["MIT", "BSD-3-Clause", "GPL-3.0"])
@pytest.mark.parametrize("before, after", [(0, 0), (100, 100), (3000, 2000)])
def test_wrapped_notice_in_a_file_of_any_length(index, name, before, after):
    import textwrap
    notice = textwrap.fill(max(li.TEMPLATES[name], key=len), 35)
    body = lambda n: "\n".join(" ".join(f"x{i}" for i in range(j, min(j + 9, n))) for j in range(0, n, 9))
    text = "\n".join(x for x in (body(before), notice, body(after)) if x)
    found, cosine, line, share = li.own_notice(text, index)
    assert found == name and cosine == pytest.approx(1) and line == -(-before // 9)
    assert share == pytest.approx(len(notice.split()) / len(text.split()), abs=0.03)


def test_notice_inside_a_longer_line(index):
    line = "a parser for tables of many kinds that is small and quick. Released under the MIT License. Bug reports go to the list of the project, patches too"
    for text in (line, "code " * 900 + "\n" + line):
        assert li.own_notice(text, index)[:2] == ("MIT", pytest.approx(1))
    assert li.own_notice("we released the new version of the plan under the bridge, with no license at all for those who fish", index)[0] is None


def test_windows_against_every_window(index):
    import random
    rng = random.Random(3)
    some = [w for t in li.TEMPLATES.values() for x in t for w in li._WORD.findall(x.lower())]
    for _ in range(30):
        words = [rng.choice(some) if rng.random() < 0.6 else f"x{rng.randrange(9)}" for _ in range(60)]
        at = rng.randrange(60)
        words[at:at] = li._WORD.findall(rng.choice(rng.choice(list(li.TEMPLATES.values()))).lower())
        want = 0.0
        for i, size in enumerate(index.sizes):
            for s in range(len(words) - size + 1):
                bag = words[s:s + size]
                square = sum((bag.count(w) * index.idf.get(w, index.other)) ** 2 for w in set(bag))
                want = max(want, sum(bag.count(w) * index.idf.get(w, index.other) * index.weights[i].get(w, 0) for w in set(bag)) / square ** 0.5)
        assert max(c for *_, c in index.windows(words)) == pytest.approx(want)


@pytest.mark.parametrize("line, name", [
    ("Licensed under the BSD 2-Clause License", "BSD-2-Clause"), ("GNU Affero General Public License, version 3", "AGPL-3.0"),
    ("CC BY-SA 4.0", "CC-BY-SA-4.0"), ("CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0"), ("Licensed under the ISC License.", "ISC"),
    ("GNU Lesser General Public License, version 2.1", "LGPL-2.1"), ("# SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: AGPL-3.0 */", "AGPL-3.0")])
def test_neighbour_licences_are_told_apart(index, line, name):
    found, cosine, *_ = li.own_notice("code and more code\n" + line + "\nand the rest of it", index)
    assert found == name and cosine >= li.HEADER_COSINE


def test_every_template_is_nearest_to_itself(index):
    for name, texts in li.TEMPLATES.items():
        for t in texts:
            assert index.best(t) == (name, pytest.approx(1.0))


def test_one_word_is_no_notice(index):
    for text in ("mit the of and in mit mit", "nd nd nd and nd of the", "er ging mit der und mit dem mit in the"):
        assert li.own_notice(text, index)[0] is None


def plain_notice(text, index, least=li.HEADER_COSINE):
    """(licence, cosine) of the best line or window, every one of them scored."""
    import math
    words = li._WORD.findall((text or "").lower())
    best = (0.0, None)

    def cosine(bag, i):
        if len(index.own_words[i] & set(bag)) < li.OWN_WORDS:
            return 0.0
        square = sum((bag.count(w) * index.idf.get(w, index.other)) ** 2 for w in set(bag))
        return sum(bag.count(w) * index.idf.get(w, index.other) * index.weights[i].get(w, 0) for w in set(bag)) / math.sqrt(square) if bag else 0.0
    bags = [(li._WORD.findall(line.lower()), None) for line in (text or "").split("\n")]
    for i, size in enumerate(index.sizes):
        size = min(size, len(words))
        for bag in [b for b, _ in bags] + [words[s:s + size] for s in range(len(words) - size + 1)]:
            best = max(best, (cosine(bag, i), index.names[i]), key=lambda x: x[0])
    if best[0] < least:
        best = max(((cosine(words, i), index.names[i]) for i in range(len(index.sizes))), key=lambda x: x[0], default=(0.0, None))
    return best


def test_bounds_lose_nothing(index):
    import random
    rng = random.Random(8)
    pool = [w for ts in li.TEMPLATES.values() for t in ts for w in li._WORD.findall(t.lower())] + "the of and to a in or by you are x y z q".split() * 20
    for k in range(60):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 40))]
        if k % 2:
            notice = li._WORD.findall(rng.choice(rng.choice(list(li.TEMPLATES.values()))))
            at = rng.randint(0, len(words))
            words[at:at] = [w for w in notice if rng.random() < 0.85]
        text = "".join(w + rng.choice("   \n") for w in words)
        cosine, name = plain_notice(text, index)
        got, c, *_ = li.own_notice(text, index)
        if cosine >= li.HEADER_COSINE + 1e-9:
            assert got is not None and c == pytest.approx(cosine), text
        elif cosine < li.HEADER_COSINE - 1e-9:
            assert got is None


def test_inheritance_in_random_trees(spark):
    import random
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        path = "/".join(rng.choice("abc") for _ in range(rng.randint(0, 4)))
        name = rng.choice(["LICENSE", "x.py", "y.py", "z.txt"])
        text = rng.choice(["Released under the MIT License", "Licensed under the ISC License", "code", "", None]) if name == "LICENSE" else rng.choice(["code", None, "text"])
        rows.append((f"{path}/{name}".lstrip("/"), text))
    rows = list(dict.fromkeys(rows))
    df = spark.createDataFrame([(p, t, "mine", 1) for p, t in rows], "path string, text string, _here string, _of int").repartition(3)
    governs = {}
    for p, t in sorted(rows, key=str):
        if t and "License" in t:
            d = p.rpartition("/")[0]
            governs.setdefault(d, []).append((-li.own_notice(t, li.TemplateIndex())[1], "MIT" if "MIT" in t else "ISC", p))
    for r in li.scan(df).collect():
        p, own = r["path"], None
        assert r["_here"] == "mine" and r["_of"] == 1
        if r["how"] == "own":
            continue
        parts = p.split("/")[:-1]
        ups = ["/".join(parts[:n]) for n in range(len(parts), -1, -1)]
        at = next((u for u in ups if u in governs), None)
        assert (r["license"], r["from_dir"]) == ((min(governs[at])[1], at) if at is not None else (None, None))

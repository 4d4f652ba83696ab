"""License scan against exact containment over every window, and the bounds its settings promise."""

import random

from zonepulse.llm import license_scan as L


def brute(text):
    """Every window of every template's size; a match reaches over the shingles that it shares."""
    words = L.template_words(text or "")
    sh = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    best = {}
    for name, t in L.TEMPLATES.items():
        tw = L.template_words(t)
        own = {tuple(tw[i:i + 5]) for i in range(len(tw) - 4)}
        window, step = L.window_of(len(tw))
        for start in range(0, len(sh), step):
            inside = sh[start:start + window - 4]
            share = len(own & set(inside)) / len(own)
            if share >= 0.8 and (name not in best or share > best[name][0]):
                at = [start + i for i, x in enumerate(inside) if x in own]
                best[name] = (share, start, at[0], at[-1] + 5)
    groups = {n: f for f, names in L.FAMILIES.items() for n in names}
    beats = lambda y, x: (groups.get(y, y) == groups.get(x, x) and best[y][0] > best[x][0]
                          and best[y][2] < best[x][3] and best[x][2] < best[y][3])
    return {n: best[n][:2] for n in best if not any(beats(y, n) for y in best)}


def texts():
    rnd = random.Random(5)
    noise = lambda n: " ".join(rnd.choice(["zu", "the", "software", "x1", "license", "é", "von"]) for _ in range(n))
    out = []
    for name, t in L.TEMPLATES.items():
        out.append(f"{noise(rnd.randint(0, 30))}\n{t}.\n{noise(rnd.randint(0, 30))}")
        out.append(t.upper().replace(" ", "\n# "))
        words = t.split()
        if len(words) > 40:
            for _ in range(3):
                edit = list(words)
                edit[rnd.randrange(len(edit))] = "CHANGED"
                out.append(noise(7) + " " + " ".join(edit) + " " + noise(9))
            out.append(" ".join(words[: len(words) // 2]))
    names = list(L.TEMPLATES)
    for _ in range(40):                 # several licenses in a text, of one family and of others, some edited
        some = []
        for name in rnd.sample(names, rnd.randint(2, 4)):
            words = L.TEMPLATES[name].split()
            if len(words) > 20 and rnd.random() < 0.6:
                words[rnd.randrange(len(words))] = "CHANGED"
            some.append(" ".join(words))
        out.append(rnd.choice([" ", "\n", f" {noise(4)} "]).join(some))
    out += [f"{L.TEMPLATES['MIT']} " * 3 + L.TEMPLATES["MIT-text"], " ".join([L.TEMPLATES["GPL-3.0-header"]] * 2),
            noise(3_000) + " " + (L.TEMPLATES["CC-BY-4.0"] + " license public ") * 200 + noise(3_000) + L.TEMPLATES["Apache-2.0-header"]]
    return out + [noise(200), "", None, "license", "Released under the MIT License " * 50]


def test_settings():
    for t in L.TEMPLATES.values():
        n = len(L.template_words(t))
        assert n >= L.SHINGLE and L.collision_probability(n) >= 0.99
        window, step = L.window_of(n)
        assert window - step + 1 >= n       # any stretch of n words lies in some window


def test_pivots_lose_nothing():
    for t in L.TEMPLATES.values():
        w = L.template_words(t)
        sh = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        assert sum(bool(set(s) & set(L.pivots())) for s in sh) > (1 - L.THRESHOLD) * len(sh)


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t in rows], "doc_id bigint, text string, license string, share double")
    got = {}
    for r in L.license_matches(docs).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.share, r.first_word)
    for i, t in rows:
        assert got.get(i, {}) == brute(t), t


def test_query_rows(spark, tmp_path):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, None), (None, "Licensed under CC BY-NC 4.0."),
            (3, ""), (4, "This work is licensed under the GNU General Public License, version 3.")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.n_licenses, r.licenses) for r in L.op10_license_scan(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, 1, "MIT"), (1, 1, "MIT"), (2, 0, ""), (None, 1, "CC-BY-NC-4.0"), (3, 0, ""), (4, 1, "GPL-3.0")], key=str)
    assert L.license_matches(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_notice_beside_an_edited_license(spark):
    gpl = L.TEMPLATES["GPL-3.0-header"].replace("useful", "helpful")
    mit = L.TEMPLATES["MIT-text"].replace("publish", "print")
    rows = [(1, "Released under the MIT License. " + gpl), (2, gpl + " Released under the MIT License."),
            (3, "Released under the MIT License. " + mit), (4, L.TEMPLATES["GPL-3.0"]),
            (5, f"Licensed under CC BY 4.0 {mit} {gpl}")]
    got = {}
    for r in L.license_matches(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == {1: {"MIT", "GPL-3.0-header"}, 2: {"MIT", "GPL-3.0-header"}, 3: {"MIT", "MIT-text"}, 4: {"GPL-3.0"},
                   5: {"CC-BY-4.0", "MIT-text", "GPL-3.0-header"}}
    assert {n for names in L.FAMILIES.values() for n in names} <= set(L.TEMPLATES)

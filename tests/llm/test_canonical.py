import random

from stemma.llm import canonical as K

REFERENCE = [
    (1, "Lat.", "lat., latein.", "Latin"), (2, "OWatru.", "awatr.,awatrun.", "Old Watrunic"), (3, "Watru.", "watr., watrun., watrunisch", "Watrunic"),
    (4, "LWatru.", "spätwatr.", "Late Watrunic"), (5, "OIr.", "air., altir.", "Old Irish"), (6, "OCS", "aksl.", "Old Church Slavonic"), (6, "OCS", "aksl.", "Old Church Slavonic"),
    (7, None, None, None),
    *[(10 * i + j, None, sp, full) for i, b in enumerate(("brenn", "tolm", "kersi", "druskal"), 1) for j, (sp, full) in enumerate(
        [(f"{b}., {b}isch", f"{b}ic"), (f"a{b}., alt{b}.", f"Old {b}ic"), (f"spät{b}.", f"Late {b}ic")])],
]
NAMES = {"altkirchenslavisch": "aksl", "altkirchenslawisch": "aksl"}
DDL = "id int, short string, spellings string, full string"


def run(spark, values, reference=REFERENCE):
    vocab = K.vocabulary(spark, spark.createDataFrame(reference, DDL), "id", "short", "spellings", "full", NAMES)
    got = K.canonicalize(spark.createDataFrame([(v,) for v in values], "v string"), vocab)
    out = {v: set() for v in values}
    for r in got.collect():
        out[r.v].add(r.entry)
    return out


def test_values(spark):
    want = {
        "lat.": {1}, " LATEIN ": {1}, "?lat.": {1}, "lateinisch": {1}, "Latin": {1}, "awatr": {2}, "altwatrunisch": {2}, "spätwatrunisch": {4}, "spaetwatrun.": {4}, "spatwatr": {4},
        "spÃ¤twatr.": {4}, "spä-twatr.": {4}, "awtarun.": {2}, "watrunnisch": {3}, "Old Wattrunic": {2}, "watrunic": {3}, "old church slavonic": {6}, "OldWatrunic": {2},
        "air. aksl.": {5, 6}, "lat./altir.": {1, 5}, "Lat-Altir": {1, 5}, "lat. u. air.": {1, 5}, "watr. (dial.)": {3}, "(watr.)": {3}, "watr. - poet.": {3}, "altkirchenslavisch": {6},
        "pihukux.": set(), "TODO": set(), "": set(), "??": set(), "x" * 5000: set(), "siehe oben": set(),
    }
    assert run(spark, list(want)) == want


def test_empty(spark):
    assert run(spark, ["lat."], []) == {"lat.": set()}
    assert run(spark, []) == {}


def test_rules_are_read_off_the_list():
    rules = K.learn(REFERENCE)
    assert rules.endings == ("isch",) and rules.prefixes == {"old": ("a", "alt"), "late": ("spät",)}
    assert K.learn([]) == K.Rules() and K.learn(REFERENCE[:3]) == K.Rules()


def test_long_tokens_are_repaired(spark):
    rnd = random.Random(1)
    word = lambda n: "".join(rnd.choice("abcdefghik") for _ in range(n))
    full = [word(n) for n in (39, 40, 41, 42, 200, 5000)]
    reference = [(i, None, w, None) for i, w in enumerate(full)]
    values = {}
    for i, w in enumerate(full):
        for at in (0, len(w) // 2, len(w) - 1):
            values |= {w[:at] + w[at + 1 :]: {i}, w[:at] + "z" + w[at:]: {i}, w[:at] + "z" + w[at + 1 :]: {i}}
        values[w[: len(w) // 2]] = set()
    assert run(spark, list(values), reference) == values


def test_list_beyond_any_bound(spark, monkeypatch):
    """A list larger than the sample its rules come from and than a broadcast gives the same."""
    want = run(spark, ["lat.", "altwatrunisch", "spätwatrunisch", "watrunnisch"])
    monkeypatch.setattr("stemma.session.BROADCAST_BYTES", 10)
    more = [(1000 + i, None, f"place{i}.", f"Place {i} City") for i in range(3000)]
    got = run(spark, ["lat.", "altwatrunisch", "spätwatrunisch", "watrunnisch", "plaec77"], REFERENCE + more)
    assert got == want | {"plaec77": {1077}}


def test_rules_come_from_the_whole_list(spark):
    """Rules that few of 60,000 entries show are learnt, the same as from those few."""
    more = [(1000, None, f"place{i}.", "Place City Hall") for i in range(60_000)]
    values = ["altwatrunisch", "spätwatrunisch", "spaetwatrun."]
    assert run(spark, values, REFERENCE + more) == {"altwatrunisch": {2}, "spätwatrunisch": {4}, "spaetwatrun.": {4}}
    for rows in (REFERENCE, REFERENCE[:3], []):
        assert K.learn_all(spark.createDataFrame(rows, "e int, short string, spellings string, full string")) == K.learn(rows)

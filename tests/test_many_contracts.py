import random

from loadlens.contracts import Contract
from loadlens.sources import inventory
from tests.conftest import rows

FILES = "path string, length long"


def test_the_rows_are_those_of_the_pattern_by_pattern_match(spark):
    r = random.Random(4)
    stems = ["a", "ab", "a.b", "é", "x_", "", "a+(b"]
    patterns = [f"{r.choice(stems)}{r.choice(['', '{month}', '{date_range}', '{month}_{date_range}'])}{r.choice(['.tsv', '_b.csv', '.tsv.gz', ''])}" for _ in range(60)]
    contracts = [Contract(p, f"T{i}") for i, p in enumerate(patterns)]
    fill = lambda p: p.replace("{month}", "2024-03").replace("{date_range}", "20240301-20240331")
    names = {fill(p) + r.choice(["", ".gz", ".bak"]) for p in patterns for _ in range(3)} | {"other.dat", ".gz", "a"}
    files = spark.createDataFrame([(f"in/{n}", i) for i, n in enumerate(sorted(names))] + [(None, 9)], FILES)
    for keep in (False, True):
        want = rows(inventory.match_contracts(files, contracts, keep))
        assert rows(inventory.match_many_contracts(files, contracts, keep)) == want and len(want) > 60
    assert inventory.match_many_contracts(files, []).count() == 0
    assert inventory.match_many_contracts(files, [], True).count() == files.count()
    assert inventory.match_many_contracts(files.limit(0), contracts, True).count() == 0


def test_candidates_follow_the_matches(spark):
    contracts = [Contract(f"set{n}_{{month}}.tsv", f"T{n}") for n in range(10_000)]
    name = "concat('in/set', id % 20000, '_2024-', lpad(id % 12 + 1, 2, '0'), '.tsv')"
    files = spark.range(100_000).selectExpr(f"{name} AS path", "id AS length")
    tested = inventory.contract_candidates(files, contracts).count()
    assert tested == inventory.match_many_contracts(files, contracts).count() == 50_000

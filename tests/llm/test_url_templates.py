"""URL templates against a plain version, on paths of many levels."""

import random

import pytest

import brute
from trailmetrics.llm import url_filter
from trailmetrics.runtime import Scratch

RULES = [
    ("a.org", "/x/", "block"),
    ("a.org", "/x/y/", "allow"),
    ("org", "/z", "block"),
    ("b.org", "/bad", "block"),
    ("b.org", "/", "allow"),
]


def urls_of_many_levels(seed, count):
    random.seed(seed)
    words = ["x", "y", "z", "bad", "item", "p1", "p2", "v10", "", "ö"]
    found = []
    for _ in range(count):
        host = random.choice(["a.org", "b.org", "c.org", "d.com"])
        path = [random.choice(words) for _ in range(random.randrange(9))]
        if random.random() < 0.4:
            path.append(f"{random.choice(['id', 'n-'])}{random.randrange(10**6)}")
        if random.random() < 0.2:
            path += [random.choice("abcdefgh") * random.randrange(1, 4), "end"]
        found.append(f"https://{host}/" + "/".join(path) if path else f"https://{host}")
    return found


def judged(spark, scratch, urls, rules=RULES, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    table = spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string")
    return url_filter.filter_urls(pages, table, scratch, **options)


@pytest.mark.parametrize(
    ("count", "options"),
    [(300, {"fanout": 4}), (300, {"fanout": 1000}), (40, {"fanout": 2, "deviation": 1.0})],
)
def test_against_a_plain_version(spark, scratch, count, options):
    urls = urls_of_many_levels(count, count)
    want = brute.url_verdicts([brute.url_parts(url) for url in urls], RULES, **options)
    rows = judged(spark, scratch, urls, **options).collect()
    assert len(rows) == len(urls)
    for row in rows:
        rule, verdict, template, purity = want[row["host"], row["path"]]
        assert (row["rule"], row["verdict"], row["template"]) == (rule, verdict, template)
        assert row["purity"] == pytest.approx(purity)
    assert len({template for _, _, template, _ in want.values()}) > 5


def test_long_paths_take_as_many_rounds_as_they_part(spark, monkeypatch):
    """Two URLs that part after 2,000 segments, and one that parts from them at once."""
    written = []
    real = Scratch.write

    def write(self, df, name, *rest, **more):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        written.append((name, plan.count("Relation ")))
        return real(self, df, name, *rest, **more)

    monkeypatch.setattr(Scratch, "write", write)
    scratch = Scratch(spark, "long_paths")
    deep = "/".join(f"s{'x' * (i % 5)}" for i in range(2000))
    urls = [f"http://h.org/{deep}/1/tail", f"http://h.org/{deep}/2/tail", "http://h.org/other"]
    found = {row["page_id"]: row for row in judged(spark, scratch, urls).collect()}
    assert found[0]["template"] == found[1]["template"] == f"/{deep}/*/tail"
    assert found[2]["template"] == "/other"
    levels = [scans for name, scans in written if name.startswith("level_")]
    # The start, the root, the place where the two part, and what follows it.
    assert len(levels) <= 4
    scratch.close()


def test_every_round_reads_what_the_one_before_wrote(spark, monkeypatch):
    """Plans do not grow with the number of rounds."""
    scans = {}
    real = Scratch.write

    def write(self, df, name, *rest, **more):
        if name.startswith("level_"):
            scans[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Relation ")
        return real(self, df, name, *rest, **more)

    monkeypatch.setattr(Scratch, "write", write)
    scratch = Scratch(spark, "rounds")
    judged(spark, scratch, urls_of_many_levels(1, 400), fanout=10**6).count()
    later = [count for name, count in scans.items() if name != "level_0"]
    assert len(later) >= 4
    assert len(set(later)) == 1 and later[0] < 10
    scratch.close()


def test_equal_rules_go_by_name(spark, scratch):
    """Both rules have nine characters; the first by name wins, whatever the order of the rules."""
    rules = [("b.a.org", "/q", "block"), ("a.org", "/qqq", "allow")]
    for given in (rules, rules[::-1]):
        (row,) = judged(spark, scratch, ["http://b.a.org/qqq"], given).collect()
        assert (row["rule"], row["verdict"]) == ("a.org/qqq", "allow")

"""Dependencies and normal forms: textbook relations, every set by brute force, and the rows themselves."""

import random
from itertools import combinations

import pytest

from quarry.operators import dependencies as D

FD = lambda x, a: D.FD(frozenset(x.split()), a)

# the enrolment relation of the course (1NF): student, course, subject, teacher, mark
ENROLMENT = ["aluno", "nome_aluno", "curso", "nome_curso", "disciplina", "carga", "professor", "nome_professor", "nota"]
ENROLMENT_FDS = [FD("aluno", "nome_aluno"), FD("aluno", "curso"), FD("curso", "nome_curso"), FD("disciplina", "carga"),
                 FD("disciplina", "professor"), FD("professor", "nome_professor"), FD("aluno disciplina", "nota")]


def brute_fds(rows, cols, max_lhs):
    def holds(x, a):
        seen = {}
        return all(seen.setdefault(tuple(r[cols.index(c)] for c in x), r[cols.index(a)]) == r[cols.index(a)] for r in rows)
    found = []
    for size in range(max_lhs + 1):
        for x in combinations(cols, size):
            for a in cols:
                if a not in x and not any(set(y) <= set(x) and b == a for y, b in found) and holds(x, a):
                    found.append((x, a))
    return {(frozenset(x), a) for x, a in found}


@pytest.mark.parametrize("seed", range(4))
def test_discover_against_every_set(spark, seed):
    rng = random.Random(seed)
    cols = ["a", "b", "c", "d", "e"]
    rows = []
    for _ in range(rng.choice([1, 12, 40])):
        a, b = rng.randrange(4), rng.choice([None, "x", "y", "z"])
        rows.append((a, b, a % 2 if seed else 1, f"{a}{b}" if rng.random() < .95 else None, rng.randrange(3)))
    rows += rows[:3]
    df = spark.createDataFrame(rows, "a long, b string, c long, d string, e long")
    got = {(d.lhs, d.rhs) for d in D.discover(df, max_lhs=3)}
    assert got == brute_fds(rows, cols, 3)


def test_null_and_its_place_matter(spark):
    df = spark.createDataFrame([(None, "u", 1), ("u", None, 2), (None, None, 3), ("", None, 4)], "a string, b string, n long")
    assert {str(d) for d in D.discover(df)} == {"n -> a", "n -> b", "a,b -> n"}
    assert D.discover(df.limit(0)) == [D.FD(frozenset(), c) for c in "abn"]


def test_cover_keys_and_closure():
    fds = [FD("a", "b"), FD("b", "c"), FD("a", "c"), FD("a b", "d"), FD("d", "a")]
    assert D.closure({"a"}, fds) == frozenset("abcd")
    assert {str(d) for d in D.minimal_cover(fds)} == {"a -> b", "a -> d", "b -> c", "d -> a"}
    assert D.candidate_keys(list("abcd"), fds) == [frozenset("a"), frozenset("d")]
    assert D.candidate_keys(list("abcde"), fds) == [frozenset("ae"), frozenset("de")]


def test_enrolment_of_the_course():
    r3 = D.synthesize_3nf(ENROLMENT, ENROLMENT_FDS)
    assert set(r3) == {frozenset(x.split()) for x in (
        "aluno nome_aluno curso", "curso nome_curso", "disciplina carga professor", "professor nome_professor",
        "aluno disciplina nota")}
    assert D.is_lossless(ENROLMENT, r3, ENROLMENT_FDS)
    # the variant in which a teacher gives one subject and a student has one teacher per subject
    cols = ["aluno", "disciplina", "professor"]
    fds = [FD("aluno disciplina", "professor"), FD("professor", "disciplina")]
    assert D.synthesize_3nf(cols, fds) == [frozenset(cols)]
    bcnf = D.decompose_bcnf(cols, fds)
    assert set(bcnf) == {frozenset(["professor", "disciplina"]), frozenset(["aluno", "professor"])}
    assert D.is_lossless(cols, bcnf, fds)
    assert not D.is_lossless(cols, [frozenset(["aluno", "disciplina"]), frozenset(["disciplina", "professor"])], fds)


@pytest.mark.parametrize("seed", range(30))
def test_normal_forms_of_random_dependencies(seed):
    rng = random.Random(seed)
    cols = list("abcdef")
    fds = [D.FD(frozenset(rng.sample(cols, rng.choice([1, 1, 2]))), rng.choice(cols)) for _ in range(rng.randrange(0, 7))]
    fds = [d for d in fds if d.rhs not in d.lhs]
    cover = D.minimal_cover(fds)
    for size in range(len(cols) + 1):
        for x in combinations(cols, size):
            assert D.closure(set(x), cover) == D.closure(set(x), fds)
    r3 = D.synthesize_3nf(cols, fds)
    assert D.is_lossless(cols, r3, fds) and frozenset().union(*r3) == frozenset(cols)
    assert all(any(d.lhs | {d.rhs} <= r for r in r3) for d in cover)   # every dependency can be checked in one relation
    bcnf = D.decompose_bcnf(cols, fds)
    assert D.is_lossless(cols, bcnf, fds) and frozenset().union(*bcnf) == frozenset(cols)
    for r in bcnf:
        for size in range(1, len(r)):
            for x in combinations(sorted(r), size):
                inside = D.closure(set(x), fds) & r
                assert inside == set(x) or inside == r


def test_rejoin_of_found_dependencies(spark):
    rng = random.Random(3)
    rows = [(i % 50, f"n{i % 50}", (i % 50) % 7, None if (i % 50) % 7 == 3 else f"c{(i % 50) % 7}", i % 11, i) for i in range(400)]
    df = spark.createDataFrame(rows, "aluno long, nome string, curso long, nome_curso string, disciplina long, nota long")
    fds = D.discover(df, max_lhs=2)
    for relations in (D.synthesize_3nf(df.columns, fds), D.decompose_bcnf(df.columns, fds)):
        assert len(relations) > 1 and D.is_lossless(df.columns, relations, fds)
        r = D.rejoin_counts(df, relations).first()
        assert (r.n_input, r.n_rejoined, r.lossless) == (400, 400, True)
    joined = D.rejoin(D.project(df, relations)).select(*df.columns)
    assert sorted(map(str, joined.collect())) == sorted(map(str, df.collect()))
    lossy = [frozenset(["aluno", "disciplina"]), frozenset(set(df.columns) - {"aluno", "nome"})]
    assert D.rejoin_counts(df, lossy).first().lossless is False


def test_one_pass_per_level(spark):
    """No join and no collected rows: a level is one two-step count per candidate set."""
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    errors = D.partition_errors(df, [frozenset("a"), frozenset("ab")])
    assert errors == {frozenset("a"): 0, frozenset("ab"): 0}


def test_most_candidates_are_refuted_by_some_classes(spark, monkeypatch):
    """Of the sets of 8 columns only those are counted on all rows that some classes could not refute; a
    rule broken by a single row in no class looked at is still refused."""
    counted = []

    def count(rows, sets):
        counted.extend(sets)
        return errors(rows, sets)

    errors = D.partition_errors
    monkeypatch.setattr(D, "partition_errors", count)
    monkeypatch.setattr(D, "LEAST_CLASSES", 16, raising=False)
    rng = random.Random(5)
    rows = [(i, i // 4, i // 8, *[rng.randrange(6) for _ in range(4)]) for i in range(3000)]
    rows = [(*r, r[1] if r[0] != 1501 else -1) for r in rows]   # h is b but for one row
    cols = list("abcdefgh")
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in cols))
    got = {(d.lhs, d.rhs) for d in D.discover(df, max_lhs=2)}
    assert got == brute_fds(rows, cols, 2)
    assert (frozenset("b"), "h") not in got and (frozenset("b"), "c") in got
    assert len(counted) < 40   # without refutation 90 and more


def test_projections_are_made_once(spark):
    df = spark.createDataFrame([(i, i % 5, i % 5 + 10) for i in range(40)], "a long, b long, c long")
    made = {}
    relations = [frozenset("ab"), frozenset("bc")]
    first = D.rejoin_counts(df, relations, made).first()
    kept = dict(made)
    assert D.rejoin_counts(df, relations, made).first() == first == (40, 40, True)
    assert set(made) == {frozenset("abc"), *relations} and all(made[r] is kept[r] for r in kept)

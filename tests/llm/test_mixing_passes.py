import math

from envstream.llm import mixing



def test_exponents_are_data_of_one_program(spark, monkeypatch):
    found = spark.createDataFrame([("a", 2, 70), ("b", 1, 20), (None, 4, 10)],
                                  "source string, n_docs long, n_tokens long").cache()
    frame, wide = type(found.groupBy("source")), []
    monkeypatch.setattr(frame, "agg", lambda self, *c, _agg=frame.agg: (
        wide.append(len(c)), _agg(self, *c))[1])
    monkeypatch.setattr(type(found), "agg", lambda self, *c, _agg=type(found).agg: (
        wide.append(len(c)), _agg(self, *c))[1])
    points = [k / 32 for k in range(33)]
    got = mixing._measures(found, 100, points, None)
    assert wide and max(wide) <= 4
    assert len(got) == 33
    for a, (entropy, repeats) in zip(points, got):
        w = [(n / 100) ** a for n in (70, 20, 10)]
        shares = [x / sum(w) for x in w]
        assert math.isclose(entropy, -sum(x * math.log(x) for x in shares), abs_tol=1e-9)
        times = [x / n for x, n in zip(w, (70, 20, 10))]
        assert math.isclose(repeats, max(times) / min(times), rel_tol=1e-9)
    budget = mixing._measures(found, 100, [1.0, 0.0], 50)
    assert math.isclose(budget[0][1], 0.5) and math.isclose(budget[1][1], 50 / 3 / 10)


def test_texts_are_shuffled_once(spark):
    rows = [(i, "w " * 9, [None, "", "a"][i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    before = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:  # the plan of offsets that are not known to be small
        for k, v in zip(before, ("false", "-1")):
            spark.conf.set(k, v)
        made = mixing.mixed(docs)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in made.collect()) == list(range(60))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    below, shuffled = [], 0
    for line in plan.splitlines():  # a line's depth is where its name begins
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        below = [(d, x) for d, x in below if d < depth] + [(depth, line)]
        if "Scan" in line:
            shuffled = max(shuffled, sum("Exchange hashpartitioning(named" in x for _, x in below
                                         if not any("Aggregate" in y for _, y in below)))
    assert shuffled == 1

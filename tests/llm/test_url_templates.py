"""Template verdicts of planted bad branches, at any depth."""

from shoplens.llm import url_templates


def _judged(spark, urls, bad):
    """{page_id: (verdict, bad_share)}; ``bad``: page_id -> label."""
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(list(bad.items()), "page_id long, bad int")
    return {r.page_id: (r.verdict, r.bad_share) for r in url_templates.judge_urls(pages, labels, []).collect()}


def test_bad_branches_are_blocked_at_any_depth(spark):
    deep = "http://deep.example/a/b/c/d/e"
    urls = [f"http://h{h}.example/x/{i}" for h in range(20) for i in range(40)]
    urls += [f"{deep}/casino/{i}" for i in range(40)] + [f"{deep}/news/{i}" for i in range(40)]
    urls += [f"{deep}/sport/{i}" for i in range(40)]                       # the only one without labels
    bad = {i: int(("casino" in u) or ("/h" in u and i % 10 == 0)) for i, u in enumerate(urls) if "sport" not in u}
    got = _judged(spark, urls, bad)
    assert {u for i, u in enumerate(urls) if got[i][0] == "block"} == {u for u in urls if "casino" in u}
    shares = {k: {got[i][1] for i, u in enumerate(urls) if k in u} for k in ("casino", "news", "sport")}
    assert min(shares["casino"]) > 0.8 and max(shares["news"]) < 0.1 and max(shares["sport"]) < 0.3


def test_alike_inner_branches_share_their_labels(spark):
    urls = [f"http://bad.example/{a}/{b}/{i}" for a in "pq" for b in "rs" for i in range(4)]
    urls += [f"http://good{h}.example/x/{i}" for h in range(10) for i in range(20)]
    got = _judged(spark, urls, {i: int("bad" in u) for i, u in enumerate(urls)})
    assert len({got[i] for i in range(16)}) == 1 and got[0][0] == "block"
    assert all(got[i][0] == "allow" for i in range(16, len(urls)))

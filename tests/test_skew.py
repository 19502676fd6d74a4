"""Hot keys: one URL and one channel name hold more than a third of all rows."""

from decimal import Decimal

from chanloom.operators import dedupe as D
from chanloom.operators import score as S

ENTRY = ("source_name string, entry_id long, name string, url string, group_title string, "
         "attrs map<string,string>, source_weight int, source_tags array<string>")


def test_hot_url_and_hot_name(spark):
    rows = []
    for i in range(3000):
        if i % 2 == 0:        # hot URL: half of all rows
            rows.append((f"s{i % 17}", i, "Hot Channel", "http://hot/1", "", {}, 50 + i % 40, []))
        elif i % 3 == 0:      # hot name, many URLs
            rows.append((f"s{i % 17}", i, "Hot Channel", f"http://alt/{i}", "", {}, 50 + i % 30, []))
        else:
            rows.append((f"s{i % 17}", i, f"Chan {i % 50}", f"http://u/{i}", "", {}, 60, []))
    df = S.pre_score(spark.createDataFrame(rows, ENTRY).repartition(16))

    uniq = D.dedupe_url(df)
    hot = [r for r in uniq.collect() if r.url == "http://hot/1"]
    assert len(hot) == 1
    # highest weight on the hot URL; ties go to the smallest source, then entry
    cands = [(r[6], r[0], r[1]) for r in rows if r[3] == "http://hot/1"]
    best = sorted(cands, key=lambda t: (-t[0], t[1], t[2]))[0]
    assert (hot[0].source_weight, hot[0].source_name, hot[0].entry_id) == best

    sel = {r.dedupe_key: r for r in D.dedupe_channels(D.with_dedupe_key(uniq), 1, 4).collect()}
    winner = sel["hot channel"]
    assert winner.url == "http://hot/1" and winner.score_dec == Decimal(f"{best[0]}.00")
    # fallbacks: the next four URLs of the hot name by score desc, then URL
    alts = sorted({(50 + i % 30, f"http://alt/{i}") for i in range(3000) if i % 2 and i % 3 == 0},
                  key=lambda t: (-t[0], t[1]))
    assert winner.fallback_urls == [u for _, u in alts[:4]]

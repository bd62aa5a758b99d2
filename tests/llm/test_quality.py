import re

from celloom.llm.quality import KEPT_PERCENT, LINE_DOCS, LINE_PERCENT, quality_rules
from tests.llm.helpers import collected, documents, words


def base(text):
    text = text or ""
    w = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    places = {}
    for k in range(len(w) - 7):
        places.setdefault(tuple(w[k : k + 8]), []).append(k)
    repeated = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(8)}
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated), failed)


def normal(line):
    line = re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    return re.sub("[0-9]", "", re.sub("[A-Z]", lambda m: m[0].lower(), line))


def plain(rows):
    holders, hosts = {}, {}
    for _, text, host in rows:
        hosts[host] = hosts.get(host, 0) + 1
        for line in (text or "").split("\n"):
            if normal(line):
                holders.setdefault((host, normal(line)), set()).add(text)
    common = {k for k, v in holders.items() if len(v) > LINE_DOCS and 100 * len(v) > LINE_PERCENT * hosts[k[0]]}
    out = []
    for i, text, host in rows:
        counts = base(text)
        gone = sum(len(words(line)) for line in (text or "").split("\n") if (host, normal(line)) in common)
        kept = not counts[-1] and 100 * (counts[0] - gone) >= KEPT_PERCENT * counts[0]
        out.append((i, *counts, kept, gone))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "common_words")


def test_counts_and_verdicts(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert collected(quality_rules(docs), *COLUMNS) == plain(rows)


def test_lines_that_a_host_repeats(spark):
    """A menu on most pages goes; pages that are little else fail, others and copies of a page do not."""
    menu = "Home About 42 us\tand OUR partners in this line of many words which all pages of the host have at their top"
    rows = []
    for k in range(40):
        own = " ".join(f"own{k}x{j}" for j in range(4 if k % 2 else 60))
        rows.append((k, f"{menu.replace('42', str(k))}\n{own}"))
    rows += [(100 + k, "a page that was copied many times over " + " ".join(f"c{j}" for j in range(30))) for k in range(60)]
    docs = documents(spark, rows).drop("source").withColumnRenamed("lang", "source").fillna({"source": "h"})
    docs = docs.withColumn("source", docs.source.substr(0, 0))
    found = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert all(found[k].kept == (k % 2 == 0) for k in range(40))
    assert all(found[k].common_words == len(words(menu)) for k in range(40))
    assert all(found[100 + k].kept and found[100 + k].common_words == 0 for k in range(60))


def test_copies_and_nulls_do_not_lower_a_share(spark):
    """A menu on all of a host's different pages goes, however often one more page was copied."""
    menu = "home about news shop help contact imprint and all the other words of a menu that each page of this host shows"
    rows = [(k, f"{menu}\nown{k}x" + "y" * (k // 26) + chr(97 + k % 26)) for k in range(100)]
    rows += [(1000 + k, "a page that was copied many times over " + " ".join(f"c{j}" for j in range(30))) for k in range(2600)]
    rows += [(9000 + k, None) for k in range(400)]
    docs = documents(spark, rows).drop("source").withColumnRenamed("lang", "source").fillna({"source": "h"})
    docs = docs.withColumn("source", docs.source.substr(0, 0))
    found = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert len(found) == 3100
    assert all(found[k].common_words == len(words(menu)) and not found[k].kept for k in range(100))
    assert all(found[1000 + k].kept and found[1000 + k].common_words == 0 for k in range(2600))


def test_empty_table(spark):
    assert quality_rules(documents(spark, [])).collect() == []

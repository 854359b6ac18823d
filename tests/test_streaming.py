import os

from conftest import SF
from labelweave.operators import records as rec
from labelweave.plans.articles import classify_articles, prepare_categories
from labelweave.sources.readers import read_articles
from labelweave.streaming import classify_stream, read_article_stream
from queries import articles as qa
from queries.common import records


def test_arriving_articles_get_the_batch_answer(spark, folder):
    categories = prepare_categories(
        qa.themed(spark, SF), qa.type_sheets(spark, SF),
        rec.type_summary(records(spark, SF), *qa.TYPE_ARGS, terms=qa.TERMS), ["domain", "subdomain", "QSE"], ["first_row"])
    os.mkdir(f"{folder}/in")
    for i, text in enumerate(["red ring and hot gear. blue bolts!", "cold plate\nlarge ring", "old bolt"]):
        with open(f"{folder}/in/{i}.txt", "w", encoding="utf-8") as fh:
            fh.write(text)
    got = []
    run = classify_stream(read_article_stream(spark, f"{folder}/in"), categories,
                          lambda out, batch: got.extend(out.result.collect()), f"{folder}/progress")
    run.awaitTermination(120)
    want = classify_articles(read_articles(spark, f"{folder}/in"), categories).result.collect()
    assert run.exception() is None and len(got) == 3
    key = lambda r: (r.article_text, r.best_theme, r.best_veille_type)
    assert sorted(map(key, got)) == sorted(map(key, want))

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from spinneret.session import local_session  # noqa: E402

SITE = "http://localhost:8080"


def _page(title, heading, paragraph, target, label):
    return (
        f'<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="UTF-8" />\n<title>{title}</title>\n</head>\n<body>\n'
        f'<h1>{heading}</h1>\n<p>{paragraph}</p>\n<a href="{target}">{label}</a>\n</body>\n</html>\n'
    )


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def site(spark):
    """Three pages that link to each other in a circle."""
    rows = [
        (0, f"{SITE}/page1.html", _page("Page 1", "Welcome to Page 1", "This is a test page for the crawler.", "/page2.html", "Go to Page 2")),
        (1, f"{SITE}/page2.html", _page("Page 2", "Page 2 here", "Another test page with some text to tokenize.", "/page3.html", "Go to Page 3")),
        (2, f"{SITE}/page3.html", _page("Page 3", "Last Test Page", "This page has words like running and run to test stemming.", "/page1.html", "Back to Page 1")),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.fixture(scope="session")
def site_index():
    """All 32 postings of the three pages: token -> page numbers. Fixed values, as the pages' words give them."""
    index = {t: {1, 2, 3} for t in "page test to".split()}
    index |= {"go": {1, 2}, "this": {1, 3}}
    index |= {t: {1} for t in "crawler for is the welcom".split()}
    index |= {t: {2} for t in "anoth here some text token with".split()}
    index |= {t: {3} for t in "and back has last like run stem word".split()}
    return index

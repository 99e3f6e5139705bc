from urllib.parse import quote, unquote

import pytest

from placeleads.functions import url


@pytest.mark.parametrize(
    "link, place",
    [
        ("https://h/maps/place/Bar+El%20Rinc%C3%B3n/@1,2", "Bar+El Rincón"),
        ("/maps/place/A%2FB/x", "A"),
        ("/maps/place/%2FB", None),
        ("/maps/search/x", None),
        ("/maps/place/", None),
        ("/place/a?b=c#d", "a?b=c#d"),
    ],
)
def test_place_id(one, link, place):
    assert one(url.place_id, link) == place


def test_decodable_urls_are_those_with_whole_utf8_sequences(many):
    segments = ["a", "%41", "%c3%B3", "%C3", "%ZZ", "%", "%4", "%FF", "%C0%80", "%ED%A0%80"]
    segments += ["%F0%9F%98%80", "%F4%90%80%80", "%E2%82%AC", "%E2%82", "a%20b%", "%E0%80%80"]

    def decodes(segment):
        if any(
            segment[i] == "%" and not all(h in "0123456789abcdefABCDEF" for h in segment[i + 1 : i + 3])
            or segment[i] == "%" and len(segment[i + 1 : i + 3]) < 2
            for i in range(len(segment))
        ):
            return False
        try:
            unquote(segment, errors="strict")
        except UnicodeDecodeError:
            return False
        return True

    found = many(url.place_url_decodes, [f"/maps/place/{s}/x" for s in segments])
    assert found == [decodes(s) for s in segments]


def test_urls_without_a_place_are_never_malformed(one):
    assert one(url.place_url_decodes, "/maps/search/%ZZ") is True
    assert one(url.place_url_decodes, None) is True


def test_absolute_url(one):
    assert one(url.absolute_url, "/maps/place/a") == "https://www.google.com/maps/place/a"
    assert one(url.absolute_url, "http://h/a") == "http://h/a"
    assert one(lambda u: url.absolute_url(u, "https://m.test"), "/a") == "https://m.test/a"


def test_url_component(many):
    texts = ["Bar & Co email", "a+b/c?d=e", "!'()*~-_.", "ñ€😀", "100%"]
    assert many(url.url_component, texts) == [quote(t, safe="!'()*~-_.") for t in texts]

"""Record splitting: every row of the reader-semantics table."""

from bibflow.sources.json_text import MALFORMED, NOT_OBJECT, UNTERMINATED, split_records


def recs(text):
    return [(r, e) for _, r, e in split_records(text)]


def test_concatenated_objects_with_braces_in_strings():
    text = '{"a":"}{"}{"b":"{"}\n{"c":1}'
    assert recs(text) == [('{"a":"}{"}', None), ('{"b":"{"}', None), ('{"c":1}', None)]


def test_leading_bom_whitespace_and_commas():
    assert recs('﻿ \n{"a":1},\n {"b":2},') == [('{"a":1}', None), ('{"b":2}', None)]


def test_array_file_and_non_object_element():
    assert recs('[{"a":1}, 2, {"b":2}]') == [('{"a":1}', None), ("2", NOT_OBJECT), ('{"b":2}', None)]


def test_single_object_and_pretty_printed():
    assert recs('{\n  "a" : 1\n}\n{\n "b": 2\n}') == [('{\n  "a" : 1\n}', None), ('{\n "b": 2\n}', None)]


def test_balanced_but_undecodable_is_skipped_and_reading_resumes():
    out = recs('{"a":1}{"b": tru}{"c":3}')
    assert out == [('{"a":1}', None), ('{"b": tru}', MALFORMED), ('{"c":3}', None)]


def test_unterminated_last_record_keeps_earlier_ones():
    out = recs('{"a":1}{"b":{"c":2}')
    assert out[0] == ('{"a":1}', None)
    assert out[1][1] == UNTERMINATED and len(out) == 2


def test_unclosed_array():
    out = recs('[{"a":1},{"b":2}')
    assert out[:2] == [('{"a":1}', None), ('{"b":2}', None)] and out[2][1] == UNTERMINATED


def test_junk_before_record():
    assert recs('xx {"a":1}') == [("xx ", MALFORMED), ('{"a":1}', None)]


def test_empty_text():
    assert recs("") == [] and recs(None) == [] and recs(" \n ") == []


def test_positions_are_consecutive():
    pos = [p for p, _, _ in split_records('{"a":1}{"a":2}[{"a":3}]')]
    assert pos == [0, 1, 2]

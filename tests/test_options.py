import pytest
from pyspark.sql import types as T

import pageframe as pf
from pageframe.functions.schemas import to_struct
from pageframe.options import compile_next_url, parse_header_lines, parse_key_values, parse_list

GOOD = {"url": "http://h/p", "schema": "a STRING"}


def broken(**more):
    return {f.option for f in pf.SourceOptions(**{**GOOD, **more}).validate()}


def test_good_options(spark):
    assert broken() == set()
    assert broken(url="https://h:8080/x?i={pagination.index}", pagination_type="increment AN index", start_index=0, index_increment=2) == set()


@pytest.mark.parametrize(
    ("more", "option"),
    [
        ({"url": "no url"}, "url"),
        ({"url": "h/p"}, "url"),
        ({"format": "yaml"}, "format"),
        ({"pagination_type": "magic"}, "pagination_type"),
        ({"error_handling": "ignore"}, "error_handling"),
        ({"error_handling": "success"}, "error_handling"),
        ({"http_errors_handling": [("2(", "Success")]}, "http_errors_handling"),
        ({"http_errors_handling": [("2..", "Maybe")]}, "http_errors_handling"),
        ({"http_errors_handling": [("5..", "Skip")]}, "http_errors_handling"),
        ({"http_errors_handling": [("5..", "Retry and send to error")]}, "http_errors_handling"),
        ({"retry_policy": "linear"}, "linear_retry_interval_s"),
        ({"retry_policy": "random"}, "retry_policy"),
        ({"max_retry_duration_s": -1}, "max_retry_duration_s"),
        ({"sample_size": 0}, "sample_size"),
        ({"max_pages_per_fetch": 0}, "max_pages_per_fetch"),
        ({"start_index": 1}, "start_index"),
        ({"next_page_token_path": "/t"}, "next_page_token_path"),
        ({"pagination_type": "Link in response body"}, "next_page_field_path"),
        ({"pagination_type": "Token in response body", "next_page_token_path": "/t"}, "next_page_url_parameter"),
        ({"pagination_type": "Custom"}, "custom_next_url"),
        ({"pagination_type": "Custom", "custom_next_url": "def other(): pass"}, "custom_next_url"),
        ({"pagination_type": "Custom", "custom_next_url": "def ("}, "custom_next_url"),
        ({"pagination_type": "Increment an index", "start_index": 0, "index_increment": 1}, "url"),
        ({"format": "xml"}, "result_path"),
        ({"format": "csv", "result_path": "/a"}, "result_path"),
        ({"format": "text", "fields_mapping": {"a": "/a"}}, "fields_mapping"),
        ({"schema": None}, "schema"),
        ({"schema": "not a schema!"}, "schema"),
        ({"format": "blob"}, "schema"),
        ({"format": "text", "schema": "a STRING, b STRING"}, "schema"),
        ({"format": "csv", "pagination_type": "Link in response body", "next_page_field_path": "/a"}, "pagination_type"),
    ],
)
def test_broken_options(spark, more, option):
    assert option in broken(**more)


@pytest.mark.parametrize("kind", ["Link in response header", "Increment an index", "Custom"])
def test_pagination_that_may_skip(spark, kind):
    extra = {
        "Increment an index": {"url": "http://h/{pagination.index}", "start_index": 0, "index_increment": 1},
        "Custom": {"custom_next_url": lambda *a: None},
    }.get(kind, {})
    assert broken(pagination_type=kind, http_errors_handling=[("5..", "Skip"), ("4..", "Send to error")], **extra) == set()


def test_check_lists_all_failures(spark):
    with pytest.raises(pf.InvalidOptions) as e:
        pf.SourceOptions(url="x", format="yaml", schema="a STRING").check()
    assert {f.option for f in e.value.failures} >= {"url", "format"}


def test_from_properties(spark):
    o = pf.SourceOptions.from_properties(
        {
            "referenceName": "r",
            "url": "http://h/p?{pagination.index}",
            "httpMethod": "GET",
            "headers": "Accept:text/x,Ref:http://x/y",
            "format": "JSON",
            "resultPath": "/items",
            "fieldsMapping": "a:/x/y,b:/z",
            "httpErrorsHandling": "2..:Success,5..:Retry and skip,.*:Fail",
            "errorHandling": "sendtoerror",
            "retryPolicy": "linear",
            "linearRetryInterval": "1",
            "maxRetryDuration": "10",
            "paginationType": "Increment an index",
            "startIndex": "0",
            "maxIndex": "6",
            "indexIncrement": "2",
            "csvSkipFirstRow": "false",
            "verifyHttps": "true",
            "keystoreFile": "",
            "schema": '{"type":"record","name":"o","fields":[{"name":"a","type":"string"},{"name":"b","type":["string","null"]}]}',
        }
    )
    assert o.validate() == []
    assert o.headers == {"Accept": "text/x", "Ref": "http://x/y"}
    assert o.rules == [("2..", "Success"), ("5..", "Retry and skip"), (".*", "Fail")]
    assert (o.start_index, o.max_index, o.index_increment, o.linear_retry_interval_s) == (0, 6, 2, 1.0)
    assert o.struct == T.StructType([T.StructField("a", T.StringType(), False), T.StructField("b", T.StringType(), True)])
    assert o.entry_handling == "sendToError" and o.supports_skipping_pages


def test_bad_property_values():
    with pytest.raises(pf.InvalidOptions, match="has no value"):
        pf.SourceOptions.from_properties({"url": "http://h", "headers": "a"})
    with pytest.raises(pf.InvalidOptions, match="startIndex"):
        pf.SourceOptions.from_properties({"url": "http://h", "startIndex": "x"})


def test_text_options():
    assert parse_key_values("a:1,b:x:y") == {"a": "1", "b": "x:y"} and parse_key_values("") == {} and parse_key_values(None) == {}
    assert parse_header_lines("A:b:c\nD: e") == {"A": "b:c", "D": " e"}
    assert parse_list("a,b") == ["a", "b"] and parse_list(None) == []
    with pytest.raises(ValueError, match="not of the form"):
        parse_header_lines("A")
    assert compile_next_url("def get_next_page_url(u, p, h):\n    return u + '!'")("a", "", {}) == "a!"


SINK = {"url": "http://h/in", "method": "POST", "batch_size": 1}


def sink_broken(schema=None, **more):
    return {f.option for f in pf.SinkOptions(**{**SINK, **more}).validate(schema)}


@pytest.mark.parametrize(
    ("more", "option"),
    [
        ({"url": "abc"}, "url"),
        ({"connect_timeout_s": -1}, "connect_timeout_s"),
        ({"read_timeout_s": -1}, "read_timeout_s"),
        ({"method": "TRACE"}, "method"),
        ({"method": "GET"}, "method"),
        ({"batch_size": 0}, "batch_size"),
        ({"message_format": "Custom"}, "message_format"),
        ({"message_format": "Pigeon"}, "message_format"),
        ({"max_retry_duration_s": -1}, "max_retry_duration_s"),
        ({"retry_policy": "linear"}, "linear_retry_interval_s"),
        ({"charset": "UTF-16"}, "charset"),
        ({"http_errors_handling": [("(", "Fail")]}, "http_errors_handling"),
    ],
)
def test_broken_sink_options(more, option):
    assert sink_broken(**more) == {option}


def test_sink_schema_checks():
    schema = T.StructType([T.StructField("id", T.StringType())])
    assert sink_broken(schema) == set()
    assert sink_broken(T.StructType([])) == {"schema"}
    assert sink_broken(schema, method="PUT", url="http://h/#id/#other") == {"url"}
    assert sink_broken(schema, method="POST", url="http://h/#other") == set()
    assert sink_broken(schema, message_format="Custom", body="#id #other") == {"body"}


def test_sink_from_properties():
    o = pf.SinkOptions.from_properties(
        {"url": "http://h", "method": "put", "batchSize": "5", "messageFormat": "json", "writeJsonAsArray": "true", "jsonBatchKey": "k",
         "requestHeaders": "A:b\nC:d:e", "followRedirects": "false", "delimiterForMessages": "\n", "charset": "UTF-8"}
    )
    assert o.validate() == [] and o.verb == "PUT" and o.batch_size == 5 and o.headers == {"A": "b", "C": "d:e"} and not o.follow_redirects


def test_schema_forms(spark):
    assert to_struct("a INT NOT NULL").simpleString() == "struct<a:int>"
    assert to_struct('{"type":"record","name":"x","fields":[{"name":"l","type":{"type":"array","items":["int","null"]}}]}')[0].dataType == T.ArrayType(T.IntegerType(), True)
    assert to_struct(T.StructType([]).json()) == T.StructType([])
    assert to_struct(None) is None and to_struct("") is None

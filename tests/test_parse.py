from eventwatch.functions.parse import dead_letters, parse_messages, valid_events
from helpers import messages, payload


def reasons(spark, rows):
    p = parse_messages(messages(spark, rows))
    return {r["message_id"]: r["failure_reason"] for r in p.select("message_id", "failure_reason").collect()}


def test_empty_object_is_missing_destination_ip(spark):
    assert reasons(spark, [("{}", "m", 0)])["m"] == "Invalid payload: Missing required field 'destination_ip'"


def test_full_object_keeps_all_eight_fields(spark):
    text = payload("1.2.3.4", "5.6.7.8", 80, 45, 67, "hostprocess.exe", "user1", request_ms=1_700_000_000_123)
    e = valid_events(parse_messages(messages(spark, [(text, "m", 5)]))).collect()[0]
    assert (e.src_ip, e.dst_ip, e.dst_port, e.bytes_sent, e.bytes_received, e.process_name, e.user_id) == \
        ("1.2.3.4", "5.6.7.8", 80, 45, 67, "hostprocess.exe", "user1")
    assert int(e.request_ts.timestamp() * 1000) == 1_700_000_000_123


def test_malformed_inputs(spark):
    r = reasons(spark, [("junk", "junk", 0), ('{"a": 1', "cut", 0), ("", "empty", 0), ("[1]", "array", 0),
                        ("null", "null", 0), ('{"destination_ip": "a", "destination_ip": "b"}', "dup", 0),
                        (b"\x7b\xff", "utf8", 0)])
    for k in ("junk", "cut", "empty", "dup", "utf8"):
        assert r[k].startswith("Failed to parse: "), k
    assert r["array"] == "Invalid payload: not an object"
    assert r["null"] == "Invalid payload: not an object"


def test_each_required_key_missing_in_call_order(spark):
    base = {"bytes_sent": "1", "destination_ip": '"d"', "destination_port": "80", "request_timestamp": "5",
            "bytes_received": "2", "source_ip": '"s"'}
    expected = {"destination_ip": "Missing required field 'destination_ip'",
                "source_ip": "Missing required field 'source_ip'", "bytes_sent": "Null bytesSent",
                "bytes_received": "Null bytesReceived", "destination_port": "Null destinationPort",
                "request_timestamp": "null"}
    rows = []
    for k in expected:
        body = ", ".join(f'"{f}": {v}' for f, v in base.items() if f != k)
        rows.append(("{" + body + "}", k, 0))
    r = reasons(spark, rows)
    for k, msg in expected.items():
        assert r[k] == "Invalid payload: " + msg
    # two faults: the earlier in call order wins (destination_ip before bytes_sent)
    two = reasons(spark, [('{"source_ip": "s", "destination_port": 80, "request_timestamp": 1, "bytes_received": 2}',
                           "two", 0)])
    assert two["two"] == "Invalid payload: Missing required field 'destination_ip'"


def test_lenient_integers(spark):
    def port(v):
        return payload().replace('"destination_port": 80', f'"destination_port": {v}')
    rows = [(port("80"), "int", 0), (port('"80"'), "str", 0), (port("80.9"), "dec", 0), (port("-80.9"), "neg", 0),
            (port("8e1"), "exp", 0), (port('"abc"'), "abc", 0), (port("{}"), "obj", 0),
            (port("99999999999.7"), "wrap", 0), (port('"99999999999"'), "big", 0)]
    p = parse_messages(messages(spark, rows))
    got = {r.message_id: (r.dst_port, r.failure_reason) for r in p.collect()}
    assert got["int"] == (80, None) and got["str"] == (80, None) and got["dec"] == (80, None)
    assert got["neg"] == (-80, None) and got["exp"] == (80, None)
    assert got["wrap"] == (1215752191, None)
    assert got["abc"] == (None, 'Invalid payload: For input string: "abc"')
    assert got["big"] == (None, 'Invalid payload: For input string: "99999999999"')
    assert got["obj"][1].startswith("Invalid payload: Unable to convert OBJECT")


def test_payload_type_dispatch(spark):
    r = reasons(spark, [(payload(), "absent", 0), (payload(), "a", 0, {"payloadType": "type A"}),
                        (payload(), "xyz", 0, {"payloadType": "xyz"})])
    assert r["absent"] is None and r["xyz"] is None
    assert r["a"] == "Invalid payload: type A parser not yet implemented"


def test_dead_letter_keeps_envelope(spark):
    d = dead_letters(parse_messages(messages(spark, [("junk", "j", 0, {"k": "v"})]))).collect()[0]
    assert bytes(d.payload) == b"junk" and d.message_id == "j" and d.attributes == {"k": "v"}


def test_non_string_fields(spark):
    r = reasons(spark, [(payload().replace('"process": "process1"', '"process": 5'), "p", 0),
                        (payload().replace('"user": "user1"', '"user": true'), "u", 0),
                        (payload().replace('"request_timestamp": 0', '"request_timestamp": "0"'), "t", 0)])
    assert r["p"] == "Invalid payload: process is not a string"
    assert r["u"] == "Invalid payload: user is not a string"
    assert r["t"] == "Invalid payload: request_timestamp is not a number"


def test_null_process_and_missing_user_are_valid(spark):
    text = payload(user=None).replace('"process": "process1",', '"process": null,')
    e = valid_events(parse_messages(messages(spark, [(text, "m", 0)]))).collect()[0]
    assert e.process_name is None and e.user_id is None


def test_parse_is_one_pass_without_shuffle(spark):
    p = parse_messages(messages(spark, [(payload(), "m", 0)]))
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_low_bits_of_numbers_of_any_length(spark):
    from decimal import Decimal, localcontext
    import random
    rng = random.Random(5)
    numbers = ["".join(rng.choice("123456789") for _ in range(n)) for n in (19, 20, 38, 39, 45, 60, 400)]
    numbers += ["-" + n for n in numbers] + [n + ".9999" for n in numbers] + ["-" + n[:20] + "." + n[20:] for n in numbers if n[0] != "-" and len(n) > 21]
    numbers += ["1e40", "123456789012345678e3", "1.23456789012345678901234567890123456789e39", "-98765432109876543210987e-3",
                "4503599627370497.9999e0", "7e31", "7e32", "1e-5", "0e99999999999", "5e99999999999", "5e-99999999999", "99999999999999999999.5E+1", "0.0000001e9"]
    rows = [(payload().replace('"destination_port": 80', f'"destination_port": {n}'), n, 0) for n in numbers]
    got = {r.message_id: r.dst_port for r in parse_messages(messages(spark, rows)).collect()}
    hidden = payload(user='\\" "destination_port": 7, \\\\').replace('"destination_port": 80', '"x": {"destination_port": 1.5}, "destination_port": 98765432109876543210.5')
    assert parse_messages(messages(spark, [(hidden, "h", 0)])).first().dst_port == (98765432109876543210 + 2 ** 31) % 2 ** 32 - 2 ** 31
    for n in numbers:
        if "99999999999" in n.lower().partition("e")[2]:
            want = 0
        else:
            with localcontext() as c:
                c.prec = 1000
                want = (int(Decimal(n)) + 2 ** 31) % 2 ** 32 - 2 ** 31
        assert got[n] == want, n


def test_text_is_read_once(spark):
    """Documents, objects and fields come from one parsed form of the text; key case and white space count as before."""
    rows = [(" \t\r\n" + payload() + " \n", "space", 0), (payload().replace('"user"', '"USER"'), "case", 0), (" [{}] ", "array", 0),
            ('"{}"', "string", 0), (" ", "blank", 0), ("{}]", "closed", 0), ("{} {}", "two", 0), ("{}, {}", "list", 0)]
    p = parse_messages(messages(spark, rows))
    got = {r.message_id: (r.failure_reason, r.user_id) for r in p.collect()}
    assert got["space"] == (None, "user1") and got["case"] == (None, None)
    assert {k: got[k][0] for k in ("array", "string")} == dict.fromkeys(("array", "string"), "Invalid payload: not an object")
    assert all(got[k][0].startswith("Failed to parse: ") for k in ("blank", "closed", "two", "list"))
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert "json_object_keys" not in plan.lower() and "jsonobjectkeys" not in plan.lower() and "from_json(StructField(process" not in plan

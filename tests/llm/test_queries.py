"""Every dealt operator is registered under its number, with the columns its contract names."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_": ["vec_id", "n_links", "component_id", "kept"],
    "op4_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op6_": ["doc_id", "fingerprint", "component_id"],
    "op7_": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op8_": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op11_": ["query_id", "rank", "vec_id", "score"],
    "op12_": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op9_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


def test_names():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


def test_columns(spark):
    for prefix, columns in COLUMNS.items():
        query = next(f for name, f in E.queries().items() if name.startswith(prefix))
        assert query(spark, SF).columns[: len(columns)] == columns

import base64
import hashlib
import hmac
import struct

from notifyq.functions.protect import FernetKey, fernet_decrypt, fernet_encrypt, generate_key
from notifyq.functions.text import mask_id


def test_fernet_token_format_and_round_trip(spark):
    key = generate_key()
    k = FernetKey(key)
    df = spark.createDataFrame([("U0002", "N1"), (None, "N2"), ("x" * 50, "N3"), ("U0002", "N4")], "c string, id string")
    out = df.select("c", fernet_encrypt("c", k, 1700000000, row_key="id").alias("t")).select(
        "c", "t", fernet_decrypt("t", k).alias("d")).collect()
    tokens = [r.t for r in out if r.t]
    assert len(set(tokens)) == 3, "same text in two rows must give two tokens"
    for r in out:
        if r.c is None:
            assert r.t is None and r.d is None
            continue
        raw = base64.urlsafe_b64decode(r.t)
        assert raw[0] == 0x80 and struct.unpack(">Q", raw[1:9])[0] == 1700000000
        assert hmac.new(k.signing, raw[:-32], hashlib.sha256).digest() == raw[-32:]
        assert r.d == r.c


def test_wrong_key_gives_null(spark):
    df = spark.createDataFrame([("U1",)], "c string")
    t = df.select(fernet_encrypt("c", generate_key(), row_key="c").alias("t"))
    assert t.select(fernet_decrypt("t", generate_key())).first()[0] is None


def test_mask(spark):
    df = spark.createDataFrame([("U0002",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(mask_id("c")).collect()] == ["U***", "***", "***"]

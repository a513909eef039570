"""Identifier protection (P12, P13) with built-in expressions only.

``fernet_encrypt`` builds a token in the Fernet format (version 0x80, 8-byte issue
time, 16-byte IV, AES-128-CBC/PKCS7 ciphertext, HMAC-SHA256 over all of it,
URL-safe base64) from ``aes_encrypt`` (given the IV, which it prepends) and two
``sha2`` calls per HMAC. Key pads are derived once on the driver from the key, so
the per-row work stays inside whole-stage codegen with no Python in the executors.
Tokens are readable by any Fernet implementation holding the same key, and
``fernet_decrypt`` reverses them (null when the HMAC does not match).
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notifyq.functions.text import mask_id  # noqa: F401  (re-exported: P13)

FERNET_VERSION = 0x80
HMAC_BLOCK = 64


def generate_key() -> str:
    """A new random key in the Fernet text form (URL-safe base64 of 32 bytes)."""
    return base64.urlsafe_b64encode(os.urandom(32)).decode()


class FernetKey:
    """Split a Fernet key into signing and encryption halves and the HMAC pads."""

    def __init__(self, key: str | bytes):
        raw = base64.urlsafe_b64decode(key if isinstance(key, bytes) else key.encode())
        if len(raw) != 32:
            raise ValueError("a Fernet key is 32 bytes, URL-safe base64 encoded")
        self.signing = raw[:16]
        self.encryption = raw[16:]
        padded = self.signing + b"\x00" * (HMAC_BLOCK - len(self.signing))
        self.ipad = bytes(b ^ 0x36 for b in padded)
        self.opad = bytes(b ^ 0x5C for b in padded)
        iv_key = hashlib.sha256(b"notifyq-iv" + raw).digest()
        self._iv_ipad = bytes(b ^ 0x36 for b in iv_key + b"\x00" * (HMAC_BLOCK - 32))
        self._iv_opad = bytes(b ^ 0x5C for b in iv_key + b"\x00" * (HMAC_BLOCK - 32))

    def hmac(self, msg: Column) -> Column:
        inner = F.unhex(F.sha2(F.concat(F.lit(bytearray(self.ipad)), msg), 256))
        return F.unhex(F.sha2(F.concat(F.lit(bytearray(self.opad)), inner), 256))

    def iv_hmac(self, msg: Column) -> Column:
        inner = F.unhex(F.sha2(F.concat(F.lit(bytearray(self._iv_ipad)), msg), 256))
        return F.unhex(F.sha2(F.concat(F.lit(bytearray(self._iv_opad)), inner), 256))


def fernet_encrypt(
    c: str | Column,
    key: str | FernetKey,
    issued_at: int | None = None,
    row_key: str | Column | None = None,
    run_nonce: bytes | None = None,
) -> Column:
    """Null-safe Fernet token of a text column (P12), as one Column expression.

    For whole DataFrames prefer ``encrypt_columns``, which stages the token body as a
    column so it is computed once (here it appears twice: emitted and under the HMAC).
    The IV is the first 16 bytes of an HMAC (keyed by a hash of the key) over a per-run
    random nonce, ``row_key`` and the plain text. It is unpredictable without the key,
    unique per row and run, and -- unlike a random draw inside ``aes_encrypt`` -- the
    same when Spark evaluates the expression twice or retries a lost task, so the HMAC
    always covers the ciphertext that is emitted.
    """
    k = key if isinstance(key, FernetKey) else FernetKey(key)
    col = F.col(c) if isinstance(c, str) else c
    ts = int(time.time()) if issued_at is None else int(issued_at)
    nonce = os.urandom(16) if run_nonce is None else run_nonce
    text = F.encode(col.cast("string"), "UTF-8")
    parts = [F.lit(bytearray(nonce))]
    if row_key is not None:
        rk = F.col(row_key) if isinstance(row_key, str) else row_key
        parts.append(F.encode(F.coalesce(rk.cast("string"), F.lit("")), "UTF-8"))
        parts.append(F.lit(bytearray(b"\x00")))
    parts.append(text)
    iv = F.substring(k.iv_hmac(F.concat(*parts)), 1, 16)
    header = bytearray(struct.pack(">BQ", FERNET_VERSION, ts))
    iv_ct = F.aes_encrypt(text, F.lit(bytearray(k.encryption)), F.lit("CBC"), F.lit("PKCS"), iv)
    body = F.concat(F.lit(header), iv_ct)
    token = F.concat(body, k.hmac(body))
    out = F.translate(F.regexp_replace(F.base64(token), r"[\r\n]", ""), "+/", "-_")
    return F.when(col.isNotNull(), out)


def fernet_decrypt(c: str | Column, key: str | FernetKey) -> Column:
    """Plain text of a Fernet token; null for null input or a failed HMAC check."""
    k = key if isinstance(key, FernetKey) else FernetKey(key)
    col = F.col(c) if isinstance(c, str) else c
    raw = F.unbase64(F.translate(col, "-_", "+/"))
    n = F.octet_length(raw)
    body = F.substring(raw, 1, n - 32)
    mac = F.substring(raw, n - 31, 32)
    iv_ct = F.substring(raw, 10, n - 9 - 32)
    plain = F.try_aes_decrypt(iv_ct, F.lit(bytearray(k.encryption)), F.lit("CBC"), F.lit("PKCS"))
    ok = (F.substring(raw, 1, 1) == F.lit(bytearray([FERNET_VERSION]))) & (mac == k.hmac(body))
    return F.when(ok, F.decode(plain, "UTF-8"))


def encrypt_columns(
    df: DataFrame,
    columns: list[str],
    key: str | FernetKey,
    issued_at: int | None = None,
    row_key: str | None = None,
    run_nonce: bytes | None = None,
    suffix: str = "_enc",
) -> DataFrame:
    """Add ``<c><suffix>`` Fernet tokens for each column, in two projections.

    ``fernet_encrypt`` as one expression uses the token body twice (once emitted, once
    under the HMAC); here the body is a column first, so Catalyst keeps it computed once
    per value (it does not inline expensive expressions that are referenced twice).
    """
    k = key if isinstance(key, FernetKey) else FernetKey(key)
    ts = int(time.time()) if issued_at is None else int(issued_at)
    nonce = os.urandom(16) if run_nonce is None else run_nonce
    header = bytearray(struct.pack(">BQ", FERNET_VERSION, ts))
    bodies = {}
    for c in columns:
        text = F.encode(F.col(c).cast("string"), "UTF-8")
        parts = [F.lit(bytearray(nonce))]
        if row_key is not None:
            parts.append(F.encode(F.coalesce(F.col(row_key).cast("string"), F.lit("")), "UTF-8"))
            parts.append(F.lit(bytearray(b"\x00")))
        parts.append(text)
        iv = F.substring(k.iv_hmac(F.concat(*parts)), 1, 16)
        iv_ct = F.aes_encrypt(text, F.lit(bytearray(k.encryption)), F.lit("CBC"), F.lit("PKCS"), iv)
        bodies[f"_body_{c}"] = F.when(F.col(c).isNotNull(), F.concat(F.lit(header), iv_ct))
    tokens = {}
    for c in columns:
        body = F.col(f"_body_{c}")
        token = F.concat(body, k.hmac(body))
        tokens[f"{c}{suffix}"] = F.translate(F.regexp_replace(F.base64(token), r"[\r\n]", ""), "+/", "-_")
    return df.withColumns(bodies).withColumns(tokens).drop(*bodies)


def decrypt_columns(df: DataFrame, mapping: dict[str, str], key: str | FernetKey) -> DataFrame:
    """Add plain-text columns ``{out: token_column}``; the decoded bytes are staged as a
    column so they are decoded once per value."""
    k = key if isinstance(key, FernetKey) else FernetKey(key)
    staged = df.withColumns(
        {f"_raw_{out}": F.unbase64(F.translate(F.col(src), "-_", "+/")) for out, src in mapping.items()}
    )
    plain_cols = {}
    for out in mapping:
        raw = F.col(f"_raw_{out}")
        n = F.octet_length(raw)
        body = F.substring(raw, 1, n - 32)
        mac = F.substring(raw, n - 31, 32)
        iv_ct = F.substring(raw, 10, n - 9 - 32)
        plain = F.try_aes_decrypt(iv_ct, F.lit(bytearray(k.encryption)), F.lit("CBC"), F.lit("PKCS"))
        ok = (F.substring(raw, 1, 1) == F.lit(bytearray([FERNET_VERSION]))) & (mac == k.hmac(body))
        plain_cols[out] = F.when(ok, F.decode(plain, "UTF-8"))
    return staged.withColumns(plain_cols).drop(*[f"_raw_{out}" for out in mapping])

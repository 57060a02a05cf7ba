"""Deterministic authenticated encryption with per-person keys.

AES-256-GCM with a synthetic nonce: the nonce is a keyed hash of the plaintext
and the associated data, so equal inputs under one key give equal ciphertexts
(joinable) and any change to key, text or associated data fails to decrypt.
The nonce has 96 bits and GCM reuses it only for an identical message.  This is
weaker than a full SIV mode; ciphertexts are not interchangeable with other
implementations.  Encryption and nonce keys are separate sub-keys.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_NONCE_BYTES = 12


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keyed_hash(key_hex: Column, *parts: Column) -> Column:
    """Nested keyed hash (hex); the inner digest has fixed length, so no extension."""
    inner = F.sha2(F.concat(key_hex, *parts), 256)
    return F.sha2(F.concat(key_hex, inner), 256)


def _secret(master: Column | str) -> Column:
    """A secret given as text goes into the plan as a one-row table, so that no plan, page or event log shows it."""
    if not isinstance(master, str):
        return master
    return SparkSession.active().createDataFrame([(master,)], "secret string").scalar()


def derive_key(master: Column | str, identity: Column) -> Column:
    """256-bit key for one identity, reproducible on task retry."""
    secret = _secret(master)
    return F.unhex(_keyed_hash(F.sha2(secret, 256), F.lit("key|"), identity))


def derive_uuid(master: Column | str, identity: Column) -> Column:
    """Stable UUID-shaped label for one identity."""
    secret = _secret(master)
    digest = _keyed_hash(F.sha2(secret, 256), F.lit("uuid|"), identity)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def cipher_key(key: Column) -> Column:
    """Encryption sub-key."""
    return F.unhex(F.sha2(F.concat(F.hex(key), F.lit("|enc")), 256))


def nonce_key(key: Column, aad: Column) -> Column:
    """Nonce sub-key (hex), bound to the associated data."""
    return _keyed_hash(F.sha2(F.concat(F.hex(key), F.lit("|nonce")), 256), aad)


def det_encrypt_with(text: Column, enc: Column, nonce: Column, aad: Column) -> Column:
    """Encrypt with sub-keys computed beforehand, once per person and not per field."""
    digest = _keyed_hash(nonce, text)
    iv = F.substring(F.unhex(digest), 1, _NONCE_BYTES)
    sealed = F.aes_encrypt(text.cast("binary"), enc, F.lit("GCM"), F.lit("DEFAULT"), iv, aad.cast("binary"))
    return F.lower(F.hex(sealed))


def det_encrypt(text: Column, key: Column, aad: Column) -> Column:
    """Lower-case hex ciphertext; NULL when any input is NULL."""
    return det_encrypt_with(text, cipher_key(key), nonce_key(key, aad), aad)


def det_decrypt_with(hex_text: Column, enc: Column, aad: Column) -> Column:
    """Inverse of :func:`det_encrypt_with`; NULL when the input is not authentic."""
    sealed = F.unhex(F.when(hex_text.rlike("^[0-9a-f]{56,}$"), hex_text))
    return F.try_aes_decrypt(sealed, enc, F.lit("GCM"), F.lit("DEFAULT"), aad.cast("binary")).cast("string")


def det_decrypt(hex_text: Column, key: Column, aad: Column) -> Column:
    """Inverse of :func:`det_encrypt`; NULL when the input is not authentic."""
    return det_decrypt_with(hex_text, cipher_key(key), aad)

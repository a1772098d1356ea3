"""Hashing, masking and encryption as Column expressions; no UDFs."""

import hashlib

from pyspark.sql import functions as F

from ledgerwatch.functions.times import moment
from ledgerwatch.schema import UNKNOWN_CUSTOMER

# Placeholders and metadata keys.
NO_CARD = "****"
NO_PHONE = "XXX-XXX-XXXX"
NO_EMAIL = "masked@email.com"
NO_SSN = "XXX-XX-XXXX"
NO_ADDRESS = "MASKED ADDRESS"
NO_MERCHANT = "UNKNOWN_MERCHANT"
EMAIL_KEYS = ["email", "email_address", "contact_email"]
PHONE_KEYS = ["phone", "phone_number", "mobile"]
MERCHANT_NAME_LENGTH = 100

NOT_DIGIT = r"\P{Nd}"  # any decimal digit of any script counts as a digit
DIGITS = r"\p{Nd}+"


def _empty(c):
    return c.isNull() | (c == "")


def sha256_identifier(c, salt):
    """sha256(salt + id) as 64 hex digits; NULL or empty gives UNKNOWN."""
    return F.when(_empty(c), F.lit(UNKNOWN_CUSTOMER)).otherwise(
        F.sha2(F.concat(F.lit(salt), c), 256)
    )


def hmac_identifier(c, salt, length=16):
    """HMAC-SHA256 of the id under the salt, cut to ``length`` hex digits."""
    key = salt.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in key))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in key))
    inner = F.sha2(F.concat(inner_pad, F.encode(c, "UTF-8")), 256)
    outer = F.sha2(F.concat(outer_pad, F.unhex(inner)), 256)
    return F.when(_empty(c), F.lit(UNKNOWN_CUSTOMER)).otherwise(F.substring(outer, 1, length))


def hash_identifier(c, cfg):
    if cfg.algorithm == "sha2":
        return sha256_identifier(c, cfg.salt)
    return hmac_identifier(c, cfg.salt, cfg.hash_length)


def _tail_of_digits(c, at_least, prefix, fallback):
    digits = F.regexp_replace(c, NOT_DIGIT, "")
    return F.when(
        F.length(digits) >= at_least, F.concat(F.lit(prefix), F.right(digits, F.lit(4)))
    ).otherwise(F.lit(fallback))


def mask_card_number(c):
    return _tail_of_digits(c, 4, "", NO_CARD)


def mask_phone(c):
    return _tail_of_digits(c, 10, "XXX-XXX-", NO_PHONE)


def mask_ssn(c):
    return _tail_of_digits(c, 9, "XXX-XX-", NO_SSN)


def mask_email(c):
    at = F.instr(c, "@")
    local = F.substring(c, F.lit(1), at - 1)
    domain = F.substring(c, at + 1, F.length(c))
    head = F.substring_index(domain, ".", 1)
    tail = F.substring_index(domain, ".", -1)
    stars = lambda text: F.repeat(F.lit("*"), F.length(text))
    masked_local = F.when(
        F.length(local) > 1,
        F.concat(F.substring(local, 1, 1), F.repeat(F.lit("*"), F.length(local) - 1)),
    ).otherwise(F.lit("*"))
    masked_domain = F.when(
        F.contains(domain, F.lit(".")), F.concat(stars(head), F.lit("."), tail)
    ).otherwise(F.lit("***.com"))
    return F.when(at > 0, F.concat(masked_local, F.lit("@"), masked_domain)).otherwise(
        F.lit(NO_EMAIL)
    )


def mask_address(c):
    masked = F.regexp_replace(F.regexp_replace(c, DIGITS, "XXX"), r"^[^,]*,", "XXX Street,")
    return F.when(_empty(c), F.lit(NO_ADDRESS)).otherwise(masked)


def sanitize_merchant_name(c):
    clean = F.regexp_replace(c, "[<>\"']", "")
    return F.when(_empty(c), F.lit(NO_MERCHANT)).otherwise(
        F.substring(clean, 1, MERCHANT_NAME_LENGTH)
    )


def mask_metadata(m):
    """Mask map values that look like an e-mail or sit under a contact key."""

    def one(key, value):
        name = F.lower(key)
        return (
            F.when(F.contains(value, F.lit("@")) & F.contains(value, F.lit(".")), mask_email(value))
            .when(value.isNotNull() & name.isin(EMAIL_KEYS), mask_email(value))
            .when(value.isNotNull() & name.isin(PHONE_KEYS), mask_phone(value))
            .otherwise(value)
        )

    return F.transform_values(m, one)


def stamp_metadata(m, as_of=None):
    """Add the masking marker and its time, replacing earlier stamps."""
    stamps = ["pii_masked", "masking_timestamp"]
    kept = F.map_filter(
        F.coalesce(m, F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(stamps)
    )
    stamp = F.create_map(
        F.lit("pii_masked"), F.lit("true"),
        F.lit("masking_timestamp"), moment(as_of).cast("string"),
    )
    return F.map_concat(kept, stamp)


def protect_customer(df, cfg, hashed=False):
    """Hashed customer id; the clear id survives only outside production.

    ``hashed``: the rows carry the hash of ``cfg`` already, as stored ones do.
    """
    if not cfg.masking_enabled:
        return df.withColumns({
            "customer_id_hash": F.col("customer_id"),
            "customer_id_original": F.col("customer_id"),
        })
    if not hashed:
        df = df.withColumn("customer_id_hash", hash_identifier(F.col("customer_id"), cfg))
    if cfg.production:
        return df.drop("customer_id", "customer_id_original")
    return df.withColumn("customer_id_original", F.col("customer_id"))


def mask_record(df, cfg, as_of=None):
    """Whole-row masking: customer, card number, contact data in metadata, marker."""
    if not cfg.masking_enabled:
        return df
    out = protect_customer(df, cfg) if "customer_id" in df.columns else df
    if "card_number" in out.columns:
        out = out.withColumn("card_number_last4", mask_card_number(F.col("card_number"))).drop(
            "card_number"
        )
    metadata = mask_metadata(F.col("metadata")) if "metadata" in out.columns else F.lit(None)
    return out.withColumn("metadata", stamp_metadata(metadata, as_of))


def mask_table(df, policy):
    """Apply one masking function per column, e.g. ``{"email": mask_email}``."""
    return df.withColumns({name: mask(F.col(name)) for name, mask in policy.items()})


def log_safe(df):
    """The row as it may appear in a log line."""
    masks = {
        "customer_id": lambda c: F.when(
            F.length(c) > 4, F.concat(F.substring(c, 1, 4), F.lit("****"))
        ).otherwise(F.lit("****")),
        "card_number": lambda c: F.when(
            F.length(c) > 4, F.concat(F.lit("****"), F.right(c, F.lit(4)))
        ).otherwise(F.lit("****")),
        "authorization_code": lambda c: F.lit("****"),
    }
    return mask_table(df, {name: m for name, m in masks.items() if name in df.columns})


def encrypt(c, key):
    """AES-GCM ciphertext (random nonce); any failure fails the job."""
    return F.aes_encrypt(c, F.lit(key), F.lit("GCM"))


def decrypt(c, key):
    """Clear text, or DECRYPTION_FAILED under a wrong key or damaged bytes."""
    clear = F.try_aes_decrypt(c, F.lit(key), F.lit("GCM")).cast("string")
    return F.when(c.isNotNull(), F.coalesce(clear, F.lit("DECRYPTION_FAILED")))

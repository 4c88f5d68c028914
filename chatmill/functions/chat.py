"""Conversation-level column expressions over
``messages ARRAY<STRUCT<role STRING, content STRING>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col_of
from .text import prefix

MESSAGE_TYPE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES_TYPE = T.ArrayType(MESSAGE_TYPE)

# --- fixed values: ChatML markers and the dedup key layout ----------------
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
KEY_TURN_SEPARATOR = "|"    # between turns of the key
KEY_ROLE_SEPARATOR = ":"    # between role and content prefix
# ---------------------------------------------------------------------------


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) and not role.startswith("`") else role
    return F.struct(r.alias("role"), col_of(content).alias("content"))


def lit_message(role: str, content: str) -> Column:
    return F.struct(F.lit(role).alias("role"), F.lit(content).alias("content"))


def has_role(messages, role: str) -> Column:
    return F.exists(col_of(messages), lambda m: m["role"] == F.lit(role))


def has_user_and_assistant(messages) -> Column:
    return has_role(messages, "user") & has_role(messages, "assistant")


def distinct_roles(messages) -> Column:
    return F.array_distinct(F.transform(col_of(messages), lambda m: m["role"]))


def content_key(messages, prefix_chars: int | None = None) -> Column:
    """``role:length:content`` of user and assistant turns joined by ``|``;
    system turns do not count.  The length (in code points) tells where a
    content ends, so no content can pass for another division into turns.
    With ``prefix_chars`` only that many code points of each turn enter the
    key."""
    kept = F.filter(col_of(messages), lambda m: m["role"].isin("user", "assistant"))
    separator = F.lit(KEY_ROLE_SEPARATOR)

    def part(m: Column) -> Column:
        content = m["content"] if prefix_chars is None else prefix(m["content"], prefix_chars)
        return F.concat(m["role"], separator, F.length(content).cast("string"), separator, content)

    return F.array_join(F.transform(kept, part), KEY_TURN_SEPARATOR)


def content_hash(messages, prefix_chars: int | None = None) -> Column:
    """SHA-256 (hex) of :func:`content_key`: a stable 256-bit dedup key."""
    return F.sha2(content_key(messages, prefix_chars), 256)


def render_turn(m: Column) -> Column:
    return F.concat(F.lit(IM_START), m["role"], F.lit("\n"), m["content"], F.lit(IM_END), F.lit("\n"))


def render_chat(messages, add_generation_prompt: bool = False) -> Column:
    """Messages -> one ChatML string; optionally open an assistant turn."""
    body = F.array_join(F.transform(col_of(messages), render_turn), "")
    if add_generation_prompt:
        body = F.concat(body, F.lit(f"{IM_START}assistant\n"))
    return body


def messages_fingerprint(messages) -> Column:
    """md5 over every ``role`` and full ``content``: compact equality check of
    a whole conversation (used by tests and the oracle comparison)."""
    parts = F.transform(col_of(messages), lambda m: F.concat(m["role"], F.lit("␞"), m["content"]))
    return F.md5(F.array_join(parts, "␟"))


def roles_text(messages) -> Column:
    return F.array_join(F.transform(col_of(messages), lambda m: m["role"]), ",")

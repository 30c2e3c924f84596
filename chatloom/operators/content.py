"""One exported message as a turn: role, what is hidden, text by content type, markers, and folded tool calls.

Everything is a built-in function of the VARIANT message, so it runs inside the row and inside codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.model import EMPTY_PARTS, EMPTY_TOOLS, ROLES
from chatloom.operators.graph import field, kind, text_field

# Content and part types of exports.
PARTED = ("text", "multimodal_text")
REASONING = ("thoughts", "reasoning_recap")
CONTEXTS = ("user_editable_context", "model_editable_context")
SOUND = ("audio_asset_pointer", "real_time_user_audio_video_asset_pointer")
FIRST_SECOND, AFTER_LAST_SECOND = -62135596800, 253402300800
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def export_time(v: Column) -> Column:
    """Seconds since the epoch as an instant, to the nearest microsecond; null if there is none or it is unusable."""
    seconds = F.when(kind(v).isin(*NUMBERS), F.try_variant_get(v, "$", "double"))
    inside = ~F.isnan(seconds) & (seconds >= FIRST_SECOND) & (seconds < AFTER_LAST_SECOND)
    return F.when(inside, F.timestamp_micros(F.rint(seconds * 1_000_000).cast("bigint")))


def bad_time(v: Column) -> Column:
    """A time that is there but unusable, which fails the conversation."""
    return F.coalesce(v.isNotNull() & (kind(v) != "VOID") & export_time(v).isNull(), F.lit(False))


def role(message: Column) -> Column:
    """A known role, else null, which fails the conversation."""
    found = text_field(message, "$.author.role")
    return F.when(found.isin(*ROLES), found)


def hidden(message: Column) -> Column:
    flag = field(message, "$.metadata.is_visually_hidden_from_conversation")
    return F.coalesce((kind(flag) == "BOOLEAN") & F.try_variant_get(flag, "$", "boolean"), F.lit(False))


def content_type(message: Column) -> Column:
    return text_field(message, "$.content.content_type")


def hidden_reasoning(message: Column) -> Column:
    return F.coalesce(content_type(message).isin(*REASONING), F.lit(False))


def _list(message: Column, path: str) -> Column:
    return F.coalesce(F.when(kind(field(message, path)) == "ARRAY", F.try_variant_get(message, path, "array<variant>")), F.array().cast("array<variant>"))


def _some(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _named(name: Column) -> Column:
    return F.coalesce(_some(name), F.lit("unknown"))


def message_text(message: Column) -> Column:
    """The text of a message by its content type; empty for types without text."""
    content = lambda name: _some(text_field(message, f"$.content.{name}"))
    lines = lambda *names: F.concat_ws("\n", *map(content, names))
    part_type = lambda p: text_field(p, "$.content_type")
    texts = F.transform(
        _list(message, "$.content.parts"),
        lambda p: F.when(kind(p) == "STRING", F.try_variant_get(p, "$", "string")).when(part_type(p) == "audio_transcription", _some(text_field(p, "$.text"))),
    )
    fields = F.coalesce(F.try_variant_get(message, "$.content", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    strings = F.filter(F.map_entries(fields), lambda e: (e["key"] != "content_type") & (kind(e["value"]) == "STRING"))
    context = F.transform(
        F.array_sort(F.transform(strings, lambda e: F.struct(e["key"].alias("key"), F.try_variant_get(e["value"], "$", "string").alias("value")))),
        lambda e: _some(e["value"]),
    )
    t = content_type(message)
    return (
        F.when(t.isin(*PARTED), F.array_join(texts, "\n"))
        .when(t.isin("code", "execution_output"), lines("text"))
        .when(t == "tether_quote", lines("title", "url", "text"))
        .when(t == "tether_browsing_display", lines("result", "summary"))
        .when(t == "system_error", F.concat_ws(": ", content("name"), content("text")))
        .when(t.isin(*CONTEXTS), F.array_join(context, "\n"))
        .otherwise("")
    )


#: Content types that give text or are kept out; others are markers named by their type.
_READABLE = (*PARTED, "code", "execution_output", "tether_quote", "tether_browsing_display", "system_error", *CONTEXTS)


def markers(message: Column) -> Column:
    """Non-text parts: of the content's parts, of an unknown content type, and of attachments."""

    def marker(p: Column) -> Column:
        t = text_field(p, "$.content_type")
        mark = lambda k, name: F.struct(F.lit(k).alias("kind"), name.cast("string").alias("name"))
        return F.when(
            kind(p) != "STRING",
            F.when(t == "image_asset_pointer", mark("image", F.lit(None))).when(t.isin(*SOUND), mark("audio", F.lit(None))).when(t == "audio_transcription", F.lit(None)).otherwise(mark("other", _named(t))),
        )

    t = content_type(message)
    of_parts = F.when(t.isin(*PARTED), F.array_compact(F.transform(_list(message, "$.content.parts"), marker))).otherwise(F.expr(EMPTY_PARTS))
    of_type = F.when(F.coalesce(t.isin(*_READABLE), F.lit(False)), F.expr(EMPTY_PARTS)).otherwise(F.array(F.struct(F.lit("other").alias("kind"), _named(t).alias("name"))))
    files = F.transform(_list(message, "$.metadata.attachments"), lambda a: F.struct(F.lit("file").alias("kind"), text_field(a, "$.name").alias("name")))
    return F.concat(of_parts, of_type, files)


def unrecognized(message: Column) -> Column:
    """Names of content and part types that aren't known; files don't count."""
    return F.transform(F.filter(markers(message), lambda p: p["kind"] == "other"), lambda p: p["name"])


def turn(message: Column) -> Column:
    """A message as a turn, with what folding needs: recipient (of a call) and author."""
    recipient = _some(text_field(message, "$.recipient"))
    return F.struct(
        role(message).alias("role"),
        message_text(message).alias("text"),
        export_time(field(message, "$.create_time")).alias("sent_at"),
        markers(message).alias("non_text_parts"),
        F.when((role(message) == "assistant") & (recipient != "all"), recipient).alias("calls"),
        text_field(message, "$.author.name").alias("author"),
    )


def folded(items: Column) -> Column:
    """Turns of kept messages in thread order: a tool call takes in the result that directly follows it."""

    def at(i: Column) -> Column:
        return F.try_element_at(items, i)

    def answers(result: Column, call: Column) -> Column:
        return F.coalesce((result["role"] == "tool") & (result["author"] == call["calls"]), F.lit(False))

    def one(t: Column, i: Column) -> Column:
        after = at(i + 2)
        result = F.when(answers(after, t), after["text"])
        call = F.array(F.struct(t["calls"].alias("name"), _some(t["text"]).alias("request"), result.alias("result")))
        both = F.when(answers(after, t), F.concat(t["non_text_parts"], after["non_text_parts"])).otherwise(t["non_text_parts"])
        is_call = t["calls"].isNotNull()
        return F.struct(
            F.when(is_call, both).otherwise(t["non_text_parts"]).alias("non_text_parts"),
            t["role"].alias("role"),
            t["sent_at"].alias("sent_at"),
            F.when(is_call, F.lit("")).otherwise(t["text"]).alias("text"),
            F.when(is_call, call).otherwise(F.expr(EMPTY_TOOLS)).alias("tool_activity"),
            F.when(i > 0, answers(t, at(F.greatest(i, F.lit(1))))).otherwise(F.lit(False)).alias("taken"),
        )

    kept = F.filter(F.transform(items, one), lambda t: ~t["taken"])
    return F.transform(kept, lambda t: F.struct(*(t[n].alias(n) for n in ("non_text_parts", "role", "sent_at", "text", "tool_activity"))))


def any_of(*rules: Column) -> Column:
    return reduce(lambda a, b: a | b, rules)

"""Chat formatting: layouts told apart by a fingerprint of their field paths, one reversible template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound

# The template's control strings, and the pattern that finds any of them, cut after its first character.
BEGIN, END, HEAD, BODY = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = r"([<\[])(/?(?:s>|INST\]))"
LOSS_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"
#: A text of so many characters may have too many names for a fingerprint.
MOST_NAMES = 100_000_000

# The fields of known layouts, and the types that a field path leaves out.
FIELDS = (
    "prompt string, completion string, response string, system string, instruction string, input string, output string, "
    "messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>"
)
TYPES = r"\b(?:VOID|VARIANT|STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|DECIMAL\(\d+,\d+\))(?=[,>]|$)"
# Values that are strings, told apart from names by the colon that follows those; and the gaps that they leave.
NAME_OR_TEXT = r'("(?:[^"\\]++|\\.)*+"\s*+:)|"(?:[^"\\]++|\\.)*+"'
GAP = r"(?<=[:\[,])(?=\s*+[,}\]])"


def _field(name: str) -> Column:
    return F.coalesce(F.col(f"__known.{name}"), F.lit(""))


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("text"))


def _listed(name: str, role: str, text: str, names: dict[str, str] | None = None) -> Column:
    def turn(item: Column) -> Column:
        own = F.coalesce(item[role], F.lit(""))
        for old, new in (names or {}).items():
            own = F.when(item[role] == old, new).otherwise(own)
        return F.struct(own.alias("role"), F.coalesce(item[text], F.lit("")).alias("text"))

    items = F.col(f"__known.{name}")
    return F.when(~F.exists(items, lambda i: i.isNull()), F.transform(items, turn))


def mappings() -> list[tuple[tuple[str, ...], Column]]:
    """The fields that a layout needs, and the turns it stands for; the first layout that finds its fields counts.

    Other fields may stand beside them.  The turns are taken from the struct
    ``__known``; those of a list are null if anything in it is no object.
    """
    asked = F.when(_field("input") == "", _field("instruction")).otherwise(
        F.concat(_field("instruction"), F.lit("\n\n"), _field("input"))
    )
    prompted = [_turn("user", _field("prompt"))]
    led = [_turn("system", _field("system")), *prompted]
    answer = lambda name: _turn("assistant", _field(name))
    return [
        (("messages",), _listed("messages", "role", "content")),
        (("conversations",), _listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
        (("instruction", "output"), F.array(_turn("user", asked), answer("output"))),
        (("instruction", "response"), F.array(_turn("user", asked), answer("response"))),
        (("system", "prompt", "completion"), F.array(*led, answer("completion"))),
        (("system", "prompt", "response"), F.array(*led, answer("response"))),
        (("prompt", "completion"), F.array(*prompted, answer("completion"))),
        (("prompt", "response"), F.array(*prompted, answer("response"))),
    ]


def fingerprint(body: Column) -> Column:
    """Hash of a JSON text's sorted nested field paths, whatever their values and types.

    Texts are taken out of the JSON before it is looked at, so their lengths
    don't matter.  What is no JSON has none.
    """
    bare = F.regexp_replace(F.regexp_replace(body, NAME_OR_TEXT, "$1"), GAP, "0")
    paths = F.schema_of_variant(F.try_parse_json(bare))
    return F.when(paths.isNotNull(), F.xxhash64(F.regexp_replace(paths, TYPES, "")))


def _layout(names: Column) -> Column:
    """Which of ``mappings`` finds the fields it needs among names, the first one; null for none."""
    layout = F.lit(None).cast("int")
    for at, (needed, _) in reversed(list(enumerate(mappings()))):
        layout = F.when(F.size(F.array_except(F.array(*map(F.lit, needed)), names)) == 0, at).otherwise(layout)
    return layout


def layouts(records: DataFrame, body: str = "body") -> DataFrame:
    """fingerprint and ``layout`` (a number in ``mappings``) of every fingerprint among the records that one describes.

    One row a fingerprint, combined before the shuffle; fingerprints nobody
    described are left out.
    """
    named = bound(records.select(body), __names=F.json_object_keys(F.col(body)), fingerprint=fingerprint(F.col(body)))
    known = named.select("fingerprint", _layout(F.col("__names")).alias("layout")).where("fingerprint is not null and layout is not null")
    return known.groupBy("fingerprint").agg(F.min("layout").alias("layout"))


def canonical_turns(records: DataFrame, body: str = "body") -> DataFrame:
    """``records`` with ``turns`` (role, text) made from the JSON text in ``body``, and its ``fingerprint``.

    The fingerprint selects one of ``mappings``, through the table ``layouts``
    makes of all fingerprints among the records: a mapping is chosen once a
    fingerprint, by the fields it needs; others beside them do no harm.
    Numbers and nested values in place of a text become their JSON.  Text that
    is no JSON has a null fingerprint; layouts nobody described keep theirs;
    both have null turns, so that they can be counted.  Missing texts and
    roles are empty, an empty list has no turns.  Texts may be as long as a
    string can be; only a body whose field names alone exceed 128 MiB has no
    fingerprint, and is mapped by its own names.

    The table is broadcast, so that no text is shuffled; it suits records whose
    described fingerprints are far fewer than they.
    """
    whole = {"maxStringLen": "2147483647"}
    known = layouts(records, body).select(F.col("fingerprint").alias("__print"), F.col("layout").alias("__layout"))
    parsed = bound(records, __known=F.from_json(body, FIELDS, whole), fingerprint=fingerprint(F.col(body)))
    parsed = parsed.join(F.broadcast(known), F.col("fingerprint") == F.col("__print"), "left")
    # What only begins like JSON has names, but can't be parsed.
    unprinted = F.col("fingerprint").isNull() & (F.length(body) > MOST_NAMES)
    layout = F.when(unprinted, _layout(F.json_object_keys(F.col(body)))).otherwise(F.col("__layout"))
    turns = F.lit(None).cast(TURNS)
    for at, (_, mapped) in enumerate(mappings()):
        turns = F.when(F.col("__chosen") == at, mapped).otherwise(turns)
    chosen = parsed.withColumn("__chosen", layout)
    return chosen.withColumn("turns", turns).drop("__known", "__print", "__layout", "__chosen", body)


def escaped(text: Column) -> Column:
    r"""A text in which no control string is left: ``\`` is doubled, and control strings get one after their first character."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), CONTROL, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def formatted(records: DataFrame) -> DataFrame:
    """``records`` with ``turns`` replaced by ``formatted`` and ``loss_runs``.

    ``formatted`` is a start mark and, per turn, head mark, role, body mark,
    text and end mark.  ``loss_runs`` are two numbers per turn, code points
    outside and under the loss mask; an assistant's text is under it, an end
    mark counts to what follows it.
    """
    role, text = lambda t: escaped(t["role"]), lambda t: escaped(t["text"])
    pieces = F.transform("turns", lambda t: F.concat(F.lit(HEAD), role(t), F.lit(BODY), text(t), F.lit(END)))

    def runs(t: Column, at: Column) -> Column:
        lead = F.when(at == 0, len(BEGIN)).otherwise(len(END)) + len(HEAD) + F.char_length(role(t)) + len(BODY)
        learnt = t["role"] == LOSS_ROLE
        size = F.char_length(text(t))
        return F.array(lead + F.when(learnt, 0).otherwise(size), F.when(learnt, size).otherwise(0))

    return records.withColumns(
        {
            "formatted": F.concat(F.lit(BEGIN), F.array_join(pieces, "")),
            "loss_runs": F.flatten(F.transform("turns", runs)),
        }
    ).drop("turns")


def read_back(records: DataFrame) -> DataFrame:
    """``records`` with the ``turns`` and the text under the mask (``loss_text``) found in ``formatted``."""
    inner = F.substring(F.col("formatted"), F.lit(len(BEGIN) + 1), F.char_length("formatted"))
    chunks = F.split(inner, END)
    chunks = F.slice(chunks, F.lit(1), F.size(chunks) - 1)

    def turn(chunk: Column) -> Column:
        role = F.substring_index(F.substring(chunk, F.lit(len(HEAD) + 1), F.char_length(chunk)), BODY, 1)
        text = F.substring(chunk, F.char_length(role) + (len(HEAD) + len(BODY) + 1), F.char_length(chunk))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    def under(chunk: Column, at: Column) -> Column:
        size = F.get("loss_runs", 2 * at + 1)
        return F.substring(chunk, F.char_length(chunk) - size + 1, size)

    split = records.withColumn("chunks", chunks)
    return split.withColumns(
        {
            "turns": F.transform("chunks", turn),
            "loss_text": unescaped(F.array_join(F.transform("chunks", under), "")),
        }
    ).drop("chunks")


def gathered(rows: DataFrame) -> DataFrame:
    """conv_id and ``turns`` in order of turn, of rows (conv_id, turn, role, text).

    Null texts and roles are empty.  Rows of one turn are ordered by role and
    text; repeated rows are turns each.  Rows without conv_id are one
    conversation.  A conversation becomes one row, since it is one text.
    """
    item = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = F.sort_array(F.collect_list(item))
    return rows.groupBy("conv_id").agg(F.transform(turns, lambda t: F.struct(t["role"], t["text"])).cast(TURNS).alias("turns"))


def as_records(conversations: DataFrame) -> DataFrame:
    """conv_id and ``body``: conversations written as the JSON layouts in which they might come.

    A question with its answer is a pair, with a system text before it a pair
    led by it; of the others those with even numbers are lists of messages,
    those with odd ones shared chats, where role names allow it.
    """
    roles = F.transform("turns", lambda t: t["role"])
    text = lambda at: F.get("turns", at)["text"]
    names = F.array(*map(F.lit, ("system", "user", "assistant")))
    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    shared = F.transform(
        "turns",
        lambda t: F.struct(
            F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"),
            t["text"].alias("value"),
        ),
    )
    body = (
        F.when(
            roles == F.array(F.lit("user"), F.lit("assistant")),
            F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))),
        )
        .when(
            roles == names, F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("completion")))
        )
        .when((F.col("conv_id") % 2 == 0) | (F.size(F.array_except(roles, names)) > 0), F.to_json(F.struct(messages.alias("messages"))))
        .otherwise(F.to_json(F.struct(shared.alias("conversations"))))
    )
    return conversations.select("conv_id", body.alias("body"))

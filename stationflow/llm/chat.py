"""Chat formatting by a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := OPEN gap text gap CLOSE end                             for a role with markers of its own
                  | ROLE gap role gap SAYS gap text gap CLOSE end           for any other role

The markers are control strings. The parser is deterministic: it cuts the text before every control string that
does not follow an escape, and a piece's own control string says what the piece is. Text that holds a control string would be
cut, so each turn is rendered as it is, read back by the parser and compared with its source; where they differ, the turn
is rendered with an escape before every control string and read back again. In a text, escapes directly before a control string
are one more than in the source, so any text comes back. Whole conversations are read back and compared once more.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import fresh


@dataclass(frozen=True)
class Template:
    """Markers of the roles and of what stands between them.

    Control strings must be prefix-free, must not overlap each other, and hold neither the escape nor the gap. `gap` is one character.
    """

    roles: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
    )
    other: tuple[str, str, str] = ("[ROLE]", "[SAYS]", "[/SAYS]")
    learnt: tuple[str, ...] = ("assistant",)
    gap: str = "\n"
    escape: str = "\\"

    def __post_init__(self) -> None:
        controls = self.controls
        if len(self.gap) != 1 or len(self.escape) != 1 or self.gap == self.escape:
            raise ValueError("gap and escape must be two different characters")
        if len(set(controls)) < len(controls) or not all(controls):
            raise ValueError("markers must differ and must not be empty")
        for a in controls:
            if self.gap in a or self.escape in a:
                raise ValueError(f"marker {a!r} holds the gap or the escape")
            for b in controls:
                if any(b.startswith(a[k:]) or (a != b and b in a) for k in range(1 if a == b else 0, len(a))):
                    raise ValueError(f"markers {a!r} and {b!r} overlap")

    @property
    def controls(self) -> list[str]:
        return [*[m for pair in self.roles.values() for m in pair], *self.other]

    @property
    def pattern(self) -> str:
        """Any control string, as a regular expression; a look at the first character rules most places out."""
        first = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        return f"(?=[{first}])(?:" + "|".join(re.escape(c) for c in self.controls) + ")"

    @property
    def _mark(self) -> str:
        return re.escape(self.escape)

    def escaped(self, text: Column) -> Column:
        """An escape before every control string."""
        return F.regexp_replace(text, f"({self.pattern})", f"{self._mark}$1")

    @property
    def _boundary(self) -> str:
        """The empty place before a control string that no escape precedes."""
        first = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        return f"(?=[{first}])(?<!{self._mark})(?={self.pattern})"

    def unescaped(self, text: Column) -> Column:
        """One escape less before every control string; a run of escapes is looked at once, from its start."""
        fewer = F.regexp_replace(text, f"{self._mark}(?<!{self._mark}{self._mark})({self._mark}*{self.pattern})", "$1")
        return F.when(text.contains(self.escape), fewer).otherwise(text)

    def block(self, role: Column, shown: Column, text: Column) -> Column:
        """One turn between the markers of its role; `shown` is the role as written where the role has none of its own."""
        gap = F.lit(self.gap)
        ask, says, close = (F.lit(m) for m in self.other)
        found = F.concat(ask, gap, shown, gap, says, gap, text, gap, close, gap)
        for name, (first, last) in self.roles.items():
            found = F.when(role == name, F.concat(F.lit(first), gap, text, gap, F.lit(last), gap)).otherwise(found)
        return found

    def bytes_behind(self, role: Column) -> Column:
        """Bytes of a block behind its text."""
        gaps = 2 * len(self.gap.encode())
        found = F.lit(len(self.other[2].encode()) + gaps)
        for name, (_, last) in self.roles.items():
            found = F.when(role == name, F.lit(len(last.encode()) + gaps)).otherwise(found)
        return found

    def parsed(self, rows: DataFrame, text: str, out: str) -> DataFrame:
        """The rows with the turns, array<struct<role, text>>, that a formatted text holds; null if it does not follow the grammar."""
        ask, says, close = self.other
        cut, pieces, read = fresh("cut"), fresh("pieces"), fresh("read")
        token = lambda p: F.regexp_extract(p, f"^{self.pattern}", 0)
        body = lambda rest: self.unescaped(F.substr(rest, F.lit(2), F.length(rest) - 2))

        def one(piece: Column, i: Column) -> Column:
            """What a piece says, and whether it may stand where it does."""
            mark, rest = piece["mark"], piece["rest"]
            before, after = F.get(F.col(pieces), i - 1), F.get(F.col(pieces), i + 1)["mark"]
            framed = (F.length(rest) >= 2) & rest.startswith(self.gap) & rest.endswith(self.gap)
            closes = rest == self.gap
            rules = [(ask, framed & (after == says), None), (says, framed & (before["mark"] == ask) & (after == close), body(before["rest"]))]
            rules.append((close, closes & (before["mark"] == says), None))
            for name, (first, last) in self.roles.items():
                rules += [(first, framed & (after == last), F.lit(name)), (last, closes & (before["mark"] == first), None)]
            fits, role = F.lit(False), F.lit(None).cast("string")
            for marker, rule, meant in rules:
                fits = F.when(mark == marker, rule).otherwise(fits)
                if meant is not None:
                    role = F.when(mark == marker, meant).otherwise(role)
            said = F.when(mark.isin(says, *[first for first, _ in self.roles.values()]), body(rest))
            return F.struct(F.coalesce(fits, F.lit(False)).alias("fits"), role.alias("role"), said.alias("text"))

        # Each step is a column of its own, so that a lambda never makes an array anew for each of its elements.
        found = rows.withColumn(cut, F.split(F.col(text), self._boundary))
        marked = F.transform(cut, lambda p: F.struct(token(p).alias("mark"), p.alias("whole")))
        rest = lambda p: F.substr(p["whole"], F.length(p["mark"]) + 1)
        marked = F.transform(marked, lambda p: F.struct(p["mark"].alias("mark"), rest(p).alias("rest")))
        found = found.withColumn(pieces, marked)
        found = found.withColumn(read, F.transform(pieces, one))
        turns = F.filter(read, lambda p: p["role"].isNotNull())
        turns = F.transform(turns, lambda p: F.struct(p["role"].alias("role"), p["text"].alias("text")))
        none = F.array().cast("array<struct<role:string,text:string>>")
        told = F.when(F.col(text) == "", none).when(F.forall(read, lambda p: p["fits"]), turns)
        return found.withColumn(out, told).drop(cut, pieces, read)


TEMPLATE = Template()


def formatted(
    rows: DataFrame,
    template: Template = TEMPLATE,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(id, formatted, loss): every conversation as one text; loss holds the byte ranges, array<struct<start, end>>, that are learnt.

    Turns come by turn number, null first, ties by role, then text; repeated rows are turns of their own. A null role or text is
    empty; rows with a null id make one conversation. The ranges cover the texts of the template's learnt roles as they stand, escapes
    included, without gaps or markers, in order. Other columns play no part; an empty table gives no rows. Raises if a
    conversation does not come back from the parser as it was. A conversation is one value, as a document is: it has to fit into a row.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = rows.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # Only the source rows cross the network; blocks are made behind the exchange.
    turns = turns.select("id", F.row_number().over(order).alias("place"), "role", "text")
    source, plain = F.struct("role", "text"), template.block(F.col("role"), F.col("role"), F.col("text"))
    read = template.parsed(turns.withColumn("block", plain), "block", "turns")
    read = read.withColumn("same", F.col("turns").eqNullSafe(F.array(source))).drop("turns")
    shown = [F.when(F.col("same"), F.col(c)).otherwise(template.escaped(F.col(c))).alias(f"shown_{c}") for c in ("role", "text")]
    safe = read.select("id", "place", "role", "text", *shown)
    block = template.block(F.col("role"), F.col("shown_role"), F.col("shown_text"))
    safe = safe.select("id", "place", "role", "text", block.alias("block"), F.octet_length("shown_text").alias("size"))
    upto = F.sum(F.octet_length("block")).over(Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    safe = safe.withColumn("end", upto - template.bytes_behind(F.col("role")))
    whole = safe.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text", "block", "end", "size"))).alias("all"))
    learnt = F.filter("all", lambda t: t["role"].isin(*template.learnt))
    joined = whole.select(
        "id",
        F.array_join(F.transform("all", lambda t: t["block"]), "").alias("formatted"),
        F.transform(learnt, lambda t: F.struct((t["end"] - t["size"]).alias("start"), t["end"].alias("end"))).alias("loss"),
        F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    back = template.parsed(joined, "formatted", "turns")
    error = F.raise_error(F.concat(F.lit("conversation does not come back: "), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    kept = F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("formatted")).otherwise(error.cast("string"))
    return back.select("id", kept.alias("formatted"), "loss")


def learnt_text(rows: DataFrame, out: str, template: Template = TEMPLATE, text: str = "formatted", loss: str = "loss") -> DataFrame:
    """The rows with the text under the mask, read from the formatted bytes and without escapes, end to end."""
    raw = fresh("raw")
    found = rows.withColumn(raw, F.col(text).cast("binary"))
    part = lambda s: F.substr(F.col(raw), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
    parts = F.transform(loss, lambda s: template.unescaped(part(s).cast("string")))
    # The size keeps the bytes a column of their own, made once and not for each range.
    return found.withColumn(out, F.when(F.octet_length(raw) >= 0, F.array_join(parts, ""))).drop(raw)

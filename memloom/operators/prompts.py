"""Token rows of blocks of documents: template, roles, positions, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memloom.functions import text

#: Roles of tokens, instead of signed numbers in one column.
TEMPLATE, DOCUMENT, QUERY, RESPONSE = "template", "document", "query", "response"


def template_split(template: Column, pad: str) -> tuple[Column, Column]:
    """What stands before and after the pad token of a template."""
    return F.substring_index(template, pad, 1), F.substring_index(template, pad, -1)


def block_tokens(docs: DataFrame, block: str, doc: str, tokens: str, head: Column) -> DataFrame:
    """block, doc_local, role, position, token: the template's head once for each block, then every document.

    Positions restart with each document; doc_local counts a block's documents
    from 1 in the order of doc and is null for the template.
    """
    rows = docs.select(F.col(block), F.col(doc).alias("_doc"), F.posexplode(tokens).alias("position", "token"))
    local = docs.groupBy(block).agg(F.array_sort(F.collect_list(doc)).alias("_docs"))
    local = local.select(block, F.posexplode("_docs").alias("_at", "_doc"))
    body = rows.join(local, [block, "_doc"]).select(block, (F.col("_at") + 1).cast("long").alias("doc_local"), F.lit(DOCUMENT).alias("role"), F.col("position").cast("long").alias("position"), "token")
    first = docs.select(block).distinct().select(block, F.posexplode(head).alias("position", "token"))
    first = first.select(block, F.lit(None).cast("long").alias("doc_local"), F.lit(TEMPLATE).alias("role"), F.col("position").cast("long").alias("position"), "token")
    return first.unionByName(body)


def asked_roles(question: Column, suffix: int, head: int) -> Column:
    """Roles of a prompt's tokens: the question's (as tokens), then those that end the turn, the last `head` of which begin the response."""
    tail = [F.lit(TEMPLATE)] * (suffix - head) + [F.lit(RESPONSE)] * head
    return F.concat(F.transform(question, lambda _: F.lit(QUERY)), F.array(*tail))


def block_arrays(rows: DataFrame, block: str) -> DataFrame:
    """A row for each block (see block_tokens; of bounded size): tokens, roles, positions, and starts, where its segments begin.

    A token sees those of its own segment up to itself: from the last start to
    its place, two numbers instead of a row of a mask.
    """
    first = F.coalesce("doc_local", F.lit(0))
    held = F.array_sort(F.collect_list(F.struct(first.alias("s"), F.col("position").alias("p"), F.col("role").alias("r"), F.col("token").alias("t"))))
    whole = rows.groupBy(block).agg(held.alias("_x"))
    new = F.filter(F.transform("_x", lambda x, i: F.when((i == 0) | (x["s"] != F.get("_x", i - 1)["s"]), i.cast("long"))), lambda i: i.isNotNull())
    return whole.select(block, F.transform("_x", lambda x: x["t"]).alias("tokens"), F.transform("_x", lambda x: x["r"]).alias("roles"), F.transform("_x", lambda x: x["p"]).alias("positions"), new.alias("starts"))


def seen_from(starts: Column, size: Column) -> Column:
    """For each of `size` places the first place that its token sees; the last one is its own."""
    return F.transform(F.sequence(F.lit(0).cast("long"), size.cast("long") - 1), lambda i: F.array_max(F.filter(starts, lambda s: s <= i)))


def regenerate_roles(prompt: Column) -> tuple[Column, Column]:
    """What follows the regenerate marker, and the role of each of its tokens.

    Template are the last cited document's block, from its bracket to its end
    marker, and all up to the request for documents; the rest is the query's.
    """
    said = F.split_part(prompt, F.lit(text.REGENERATE), F.lit(2))
    mark = f"]{text.OBJECT_END}["
    tail = F.concat(F.lit("["), F.substring_index(said, mark, -1))
    cited = said.contains(mark) & tail.contains(text.OBJECT_END)
    first = text.token_count(F.left(said, F.length(said) - F.length(tail)))
    size = text.token_count(F.substring_index(tail, text.OBJECT_END, 1))
    asked = text.token_count(F.concat(F.substring_index(said, text.REQUEST, 1), F.lit(text.REQUEST)))
    head = F.when(said.contains(text.REQUEST), asked).otherwise(0)
    role = lambda _, i: F.when((i < head) | (cited & (i >= first) & (i < first + size)), TEMPLATE).otherwise(QUERY)
    return said, F.transform(text.tokens(said), role)


def query_positions(tokens: Column, top_k: int) -> Column:
    """Positions of a question's tokens: they start behind the places of the best documents."""
    return F.transform(tokens, lambda _, i: (i + (3 + top_k)).cast("long"))


def with_role(rows: DataFrame, *roles: str) -> DataFrame:
    return rows.where(F.col("role").isin(*roles))


def context_offsets(template: Column, chunks: Column) -> dict[str, Column]:
    """Where a sample's chunks and its question start in its context."""
    return {"chunks_at": template.cast("long"), "question_at": (template + chunks).cast("long")}


def checked(queries: DataFrame, text: str, length: Column, most: int) -> DataFrame:
    """queries; an empty one, or one longer than `most` tokens, is an error when it is read."""
    ok = F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.raise_error(F.lit("a query is empty"))).when(length > most, F.raise_error(F.lit("a query is too long"))).otherwise(F.col(text))
    return queries.withColumn(text, ok)

"""Text as columns: tokens, templates, answers, citations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers of prompts and answers.
START, END, OBJECT_END = "<|im_start|>", "<|im_end|>", "<|object_ref_end|>"
ANSWER, ANCHOR, REGENERATE = "The answer to the question is:", "\nPlease answer the question based", "<regenerate>"
QUESTION, TEXT_END, RETRIEVE_END = "The user's question is:", "<|endoftext|>", "<End-of-Retrieve>"
HISTORY, REQUEST = "historical document information\n\n", "Please return all documents related to the question"
WHITE = " \t\n\x0b\x0c\r"


def tokens(text: Column) -> Column:
    """Runs of signs that are not white space; the stand-in for a tokenizer."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(\S+)"), F.lit(1))


def token_count(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def chunk_count(n_tokens: Column, pool: int) -> Column:
    return F.floor((n_tokens + (pool - 1)) / pool).cast("long")


def composed(doc_id: Column, text: Column) -> Column:
    """A document between its markers, with its id before and after it."""
    return F.concat(F.lit(f"{START}["), doc_id.cast("string"), F.lit("]. "), text, F.lit("["), doc_id.cast("string"), F.lit(f"]{END}"))


def asked(question: Column, prefix: str, suffix: str) -> Column:
    return F.concat(F.lit(prefix), question, F.lit(suffix))


def answer_of(generated: Column) -> Column:
    """What stands after the last answer marker and before the end marker, trimmed."""
    return F.trim(F.substring_index(F.substring_index(generated, ANSWER, -1), END, 1))


def cleaned(answer: Column) -> Column:
    """What a judge sees: without end markers, tags, reasoning and the question; what the first `Answer:` says, if there is one."""
    without = lambda c, *marks: without(F.replace(c, F.lit(marks[0]), F.lit("")), *marks[1:]) if marks else c
    said = F.substring_index(without(answer, END, TEXT_END), "<answer>", -1)
    said = without(F.substring_index(said, f"{ANSWER} ", -1), "</answer>", QUESTION)
    last = F.substring_index(said, "</think>", -1)
    return F.when(last.contains("Answer:"), F.btrim(F.split(last, "Answer:")[1], F.lit(WHITE))).otherwise(last)


def after_anchor(text: Column) -> Column:
    """The text from the anchor sentence on; null if it is missing."""
    at = F.instr(text, ANCHOR)
    return F.when(at > 0, F.substr(text, at))


def cited_ids(text: Column) -> Column:
    """Distinct ids in square brackets, ascending."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.cast("long"))))


def must_regenerate(text: Column) -> Column:
    return F.rtrim(text).endswith(OBJECT_END) & ~text.contains(ANSWER)


def round_ended(inner: Column, first: Column) -> Column:
    """Whether a round of generation is over: its end marker came, or in later rounds what came is neither an id nor the start of the retrieval's end."""
    other = ~inner.rlike(r"^\[[0-9]*\]?$") & ~F.lit(RETRIEVE_END).startswith(inner)
    return inner.contains(OBJECT_END) | (~first & other)


def retrieval_ended(response: Column, first: Column, most: int = 1000) -> Column:
    """Whether no more rounds follow: the model says so, or the first round's text is too long."""
    return response.contains(RETRIEVE_END) | (first & (F.char_length(response) > most))


def retrieval_over(out: Column, first: Column, most: int = 1000) -> Column:
    """Whether what a whole round said ends retrieval: as above, or a later round said more than one id before its end marker."""
    said = F.substring_index(out, OBJECT_END, 1)
    return retrieval_ended(out, first, most) | (~first & ~said.rlike(r"^\[[0-9]*\]?$"))


def question_of(prompt: Column) -> Column:
    """What a prompt asks, between the documents' heading and the request for documents."""
    return F.substring_index(F.substring_index(prompt, HISTORY, -1), f"\n{REQUEST}", 1)


def question_again(question: Column) -> Column:
    """The question as it is put once more after retrieval."""
    return F.concat(F.lit(f"{START}{QUESTION} "), question, F.lit(f"\n{OBJECT_END}"))


def judged(reply: Column) -> Column:
    """The first digit up to 5 in a judge's reply, else 0."""
    found = F.regexp_extract(F.coalesce(reply, F.lit("")), "[0-5]", 0)
    return F.when(found == "", 0).otherwise(found.cast("int")).cast("long")


def human_bytes(size: Column) -> Column:
    """A number of bytes for readers: in powers of 1024 up to P, whole up to M, with one decimal from G, halves to even; less than one byte is 0B."""
    units = "BKMGTP"
    said = F.lit("0B")
    for k, unit in enumerate(units):
        scaled = size.cast("double") / 1024.0**k
        shown = F.bround(scaled).cast("long").cast("string") if k < 3 else F.format_string("%.1f", F.bround(scaled, 1))
        said = F.when(size >= (1024**k), F.concat(shown, F.lit(unit))).otherwise(said)
    return said


def matches(reply: Column) -> Column:
    low = F.lower(reply)
    return low.contains("match") & ~low.contains("mismatch")

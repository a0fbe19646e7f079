"""Settings, as fixed values of the data model: limits, patterns and formats that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

#: Characters of a token where no tokenizer is at hand; tokens a request costs besides its text.
CHARS_PER_TOKEN = 2.2
REQUEST_TOKENS = 50

#: Splitting: tokens of a piece, words of overlap, separators from the coarsest to the finest.
PIECE_TOKENS = 500
OVERLAP_WORDS = 50
SEPARATORS = ("\n\n", "\n", ". ", " ", "")

#: Trees: tokens at which a leaf is begun anew or cut, and below which parents, siblings and headers are merged.
LEAF_TOKENS = 500
CUT_TOKENS = 4000
PARENT_TOKENS = 500
SIBLING_TOKENS = 1000
HEADER_TOKENS = 200

#: Heading detection: tokens of a batch, headings shown of earlier batches, reply tokens of an item and of the frame, reserve.
HEADING_BATCH_TOKENS = 4000
HEADING_CONTEXT = 5
HEADING_ITEM_TOKENS = 22
HEADING_FRAME_TOKENS = 100
HEADING_RESERVE = 1.25
HEADING_GAP = 3

#: Retrieval.
PREFILTER = 100
PREFILTER_MOST = 120
PHRASE_BONUS = 50.0
NEIGHBOUR_STEPS = (1, -1, 2, -2, 3, -3)
NEIGHBOURS = 6
SNIPPET_WORDS = 150
SNIPPET_LEAST = 20
LEAST_CANDIDATES = 5
TOP_K = 5

#: The model: context, reserve, reply, temperature, seconds.
CONTEXT_TOKENS = 65_536
CONTEXT_RESERVE = 1_024
REPLY_TOKENS = 4_000
TEMPERATURE = 0.2
LEAST_TIMEOUT = 120.0
SECONDS_PER_TOKEN = 0.05
ATTEMPTS = 5
BACKOFF = 5.0
RETRY_STATUS = (500, 503, 408, 504)

#: Labels and answers.
TABLE_WINDOW = 2
TABLE_LEAST = 2
TABLE_GIVEN = 1
OUTPUT_SNIPPET = 200
NO_ANSWER = "Not enough information to answer the question."
QUESTION_TYPES = ("one-hop", "multi-hop", "table")
DIFFICULTIES = ("easy", "medium", "hard")
RELATED = 2
LIST_DOCUMENTS = 50


@dataclass(frozen=True)
class Limits:
    """Tokens that a prompt may have."""

    context: int = CONTEXT_TOKENS
    reserve: int = CONTEXT_RESERVE
    reply: int = REPLY_TOKENS

    @property
    def prompt(self) -> int:
        return self.context - self.reserve - self.reply

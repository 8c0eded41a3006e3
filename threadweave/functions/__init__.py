"""Column expressions: the Java string hash and the cleaning predicates."""

from threadweave.functions.hashing import java_string_hash, java_string_hash_expr
from threadweave.functions.predicates import author_present, has_comments, subreddit_in

__all__ = ["java_string_hash", "java_string_hash_expr", "author_present", "has_comments", "subreddit_in"]

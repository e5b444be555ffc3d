"""DataFrame operators: postings, matching, ranking, phrases, trends."""

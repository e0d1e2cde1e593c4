"""DataFrame operators that hold up when one key owns a large share of the rows."""

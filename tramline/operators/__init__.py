"""DataFrame to DataFrame operators. None of them touches a path or starts a stream."""

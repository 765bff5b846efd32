"""The standing questions: each function is one DataFrame plan."""

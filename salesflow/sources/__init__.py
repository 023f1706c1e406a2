"""Message-topic and file-replay sources."""

"""Tables on disk: the index store, the text form of word entries, raw inputs."""

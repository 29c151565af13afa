"""One function per stage of the weekly update: read a queue, transform, write."""

"""docsync.streaming"""

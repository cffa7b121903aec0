"""docsync.sources"""

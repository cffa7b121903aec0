"""docsync.operators"""

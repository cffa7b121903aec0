"""docsync.jobs"""

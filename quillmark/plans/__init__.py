"""quillmark.plans"""

"""Readers and writers for pairs, manifests, scores, file trees and configs."""
